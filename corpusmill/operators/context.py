"""Linked chunks of hits and context blocks under a budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import base_name

BUDGET, PER_HIT = 9000, 2


def _nearest(targets: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(linked_to, _page, best): for each file and page asked for, the k chunks nearest to the page, in order.

    Both sides are brought down to pages before they meet: a page keeps its first k chunks and, beside them, those of the
    k pages before and after; the last page up to the one asked for then holds the nearest chunks.
    """
    first = Window.partitionBy("linked_to", "linked_page").orderBy("linked_id", "linked_seq")
    top = targets.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k)
    entry = F.struct(F.col("linked_page").alias("page"), F.col("linked_id").alias("id"), F.col("linked_seq").alias("seq"), F.col("linked_start").alias("start"))
    pages = top.groupBy("linked_to", "linked_page").agg(F.collect_list(entry).alias("own"))
    along = Window.partitionBy("linked_to").orderBy("linked_page")
    beside = [F.lag("own", i).over(along) for i in range(1, k)] + [F.lead("own", i).over(along) for i in range(1, k + 1)]
    around = F.flatten(F.filter(F.array("own", *beside), lambda x: x.isNotNull()))
    known = pages.select("linked_to", F.col("linked_page").alias("_page"), F.lit(0).alias("_asked"), around.alias("_around"))
    asks = asked.select("linked_to", "_page").distinct().withColumns({"_asked": F.lit(1), "_around": F.lit(None).cast(known.schema["_around"].dataType)})
    at = Window.partitionBy("linked_to").orderBy("_page", "_asked")
    below = F.last("_around", ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first("_around", ignorenulls=True).over(at.rowsBetween(0, Window.unboundedFollowing))
    found = known.unionByName(asks).withColumn("_near", F.coalesce(below, above)).where("_asked = 1 AND _near IS NOT NULL")
    ranked = F.array_sort(F.transform("_near", lambda e: F.struct(F.abs(e["page"] - F.col("_page")).alias("far"), e["page"].alias("page"), e["id"].alias("id"), e["seq"].alias("seq"), e["start"].alias("start"))))
    return found.select("linked_to", "_page", F.slice(ranked, 1, k).alias("best"))


def linked_chunks(hits: DataFrame, chunks: DataFrame, links: DataFrame, per_hit: int = PER_HIT) -> DataFrame:
    """(query_id, rank, n, linked_to, linked_role, linked_seq, linked_id, linked_page, linked_start, linked_text): for each
    hit the chunks of the linked file nearest to its page.

    Null pages count as 0 in linked_page, linked_start keeps them; ties go to the lower page, then the smaller chunk_id.
    chunk_seq is unique; a path has one link. Texts are fetched for the chunks that were chosen only.
    """
    ends = links.select(F.col("path").alias("source_file"), F.col("linked_to"), F.when(F.col("role") == "question", "answer").otherwise("question").alias("linked_role"))
    page = F.coalesce(F.col("page_start"), F.lit(0))
    targets = chunks.join(links.select(F.col("linked_to").alias("source_file")).distinct(), "source_file", "left_semi").select(
        F.col("source_file").alias("linked_to"), F.col("chunk_seq").alias("linked_seq"), F.col("chunk_id").alias("linked_id"), page.alias("linked_page"), F.col("page_start").alias("linked_start")
    )
    asked = hits.join(ends, "source_file").select("query_id", "rank", "linked_to", "linked_role", page.alias("_page"))
    near = asked.join(_nearest(targets, asked, per_hit), ["linked_to", "_page"]).select("query_id", "rank", "linked_to", "linked_role", F.posexplode("best").alias("_i", "_b"))
    told = near.select("query_id", "rank", (F.col("_i") + 1).alias("n"), "linked_to", "linked_role", F.col("_b.seq").alias("linked_seq"), F.col("_b.id").alias("linked_id"), F.col("_b.page").alias("linked_page"), F.col("_b.start").alias("linked_start"))
    return told.join(chunks.select(F.col("chunk_seq").alias("linked_seq"), F.col("text").alias("linked_text")), "linked_seq")


def contexts(hits: DataFrame, linked: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(query_id, context, blocks, used_chars): excerpt blocks in order of rank, each followed by its linked blocks.

    A page that is null prints as None. A hit's block that does not fit ends the context; a linked one that does not fit is passed over. A linked chunk that
    is a hit or was tried before is not tried again. The joining line ends are not charged. A query's blocks are as many
    as its hits allow, so the fold runs over a short array.
    """
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    label = F.format_string("[Excerpt %d | %s | p%s]\n%s\n", "rank", base_name(F.col("source_file")), page("page_start"), "text")
    own = hits.select("query_id", "rank", F.lit(0).alias("n"), "chunk_id", label.alias("block"))
    title = F.format_string("[Linked %s for Excerpt %d | %s | p%s]\n%s\n", F.when(F.col("linked_role") == "answer", "SOLUTION").otherwise("QUESTION"), "rank", base_name(F.col("linked_to")), page("linked_start"), "linked_text")
    extra = linked.join(hits.select("query_id", F.col("chunk_id").alias("linked_id")), ["query_id", "linked_id"], "left_anti")
    first = F.row_number().over(Window.partitionBy("query_id", "linked_id").orderBy("rank", "n"))
    extra = extra.withColumn("_first", first).where("_first = 1").select("query_id", "rank", "n", F.col("linked_id").alias("chunk_id"), title.alias("block"))
    rows = own.unionByName(extra).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "n", "block"))).alias("b"))
    start = F.struct(F.lit(0).alias("used"), F.lit(False).alias("ended"), F.array().cast("array<string>").alias("kept"))

    def step(state, b):
        fits = state["used"] + F.length(b["block"]) <= budget
        take = ~state["ended"] & fits
        return F.struct(
            F.when(take, state["used"] + F.length(b["block"])).otherwise(state["used"]).alias("used"),
            (state["ended"] | ((b["n"] == 0) & ~fits)).alias("ended"),
            F.when(take, F.array_append(state["kept"], b["block"])).otherwise(state["kept"]).alias("kept"),
        )

    folded = rows.select("query_id", F.aggregate("b", start, step).alias("s"))
    return folded.select("query_id", F.array_join("s.kept", "\n").alias("context"), F.size("s.kept").alias("blocks"), F.col("s.used").alias("used_chars"))
