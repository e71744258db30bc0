"""Vector search and its evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.needles import found_in

K, OVERFETCH, QUERY_BLOCK, NEEDLE_BLOCK = 8, 5, 2_000, 100_000


def top_k(queries: DataFrame, corpus: DataFrame, k: int = K, block: int = QUERY_BLOCK, digits: int = 6) -> DataFrame:
    """(query_id, vec_id, score, rank): the k vectors of highest cosine for each query, ties by id.

    The queries are a stated set, sent in blocks of at most `block` vectors. Each task multiplies its vectors with a
    block, batch by batch, and keeps its own k best of each query; only those are shuffled. queries: (query_id,
    embedding), corpus: (vec_id, embedding). Vectors that are null, empty, of length zero or of another dimension than
    the query have no score. Scores are rounded to `digits` before ranking, so that ties do not depend on the order of
    additions.
    """
    spark = corpus.sparkSession
    rows = queries.where("embedding IS NOT NULL AND size(embedding) > 0").select("query_id", "embedding")
    n = rows.count()
    parts = max(1, -(-n // block))
    numbered = rows.withColumn("_part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
    kind = corpus.schema["vec_id"].dataType.simpleString()
    query_kind = queries.schema["query_id"].dataType.simpleString()
    best = None
    for part in range(parts):
        mine = numbered.where(F.col("_part") == part).collect() if parts > 1 else rows.collect()
        sent = spark.sparkContext.broadcast([(r["query_id"], np.asarray(r["embedding"], np.float64)) for r in mine])
        found = corpus.select("vec_id", "embedding").mapInPandas(_nearest(sent, k, digits), f"query_id {query_kind}, vec_id {kind}, score double")
        best = found if best is None else best.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def _nearest(sent, k: int, digits: int):
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_size: dict[int, list] = {}
        for i, v in sent.value:
            if v.any():
                by_size.setdefault(len(v), []).append((i, v / np.linalg.norm(v)))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            full = batch[batch["embedding"].notna()]
            sizes = full["embedding"].map(len)
            for size, asked in by_size.items():
                own = full[sizes == size]
                if not len(own):
                    continue
                m = np.stack(own["embedding"].to_list()).astype(np.float64)
                norm = np.linalg.norm(m, axis=1)
                keep = norm > 0
                m, ids = m[keep] / norm[keep, None], own["vec_id"].to_numpy()[keep]
                scores = np.round(np.stack([v for _, v in asked]) @ m.T, digits)
                old = held.get(size)
                ids = np.broadcast_to(ids, scores.shape)
                if old is not None:
                    scores, ids = np.concatenate([old[0], scores], 1), np.concatenate([old[1], ids], 1)
                order = np.lexsort((ids, -scores), axis=1)[:, :k]
                held[size] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
        for size, (scores, ids) in held.items():
            asked = [i for i, _ in by_size[size]]
            yield pd.DataFrame({"query_id": np.repeat(asked, scores.shape[1]), "vec_id": ids.reshape(-1), "score": scores.reshape(-1)})

    return nearest


def search(queries: DataFrame, corpus: DataFrame, k: int = K, where: Column | None = None, contains: str | None = None, source: str = "source_file", overfetch: int | None = None) -> DataFrame:
    """Hits within the rows that a filter and a part of the source name leave.

    The filters come before the search, so k hits come out where there are k rows. With `overfetch` the source is only
    looked at among the first overfetch*k hits, as a store does that cannot search by substring; fewer than k may be left.
    """
    corpus = corpus if where is None else corpus.where(where)
    matches = F.contains(F.lower(F.col(source)), F.lit((contains or "").lower()))
    if contains and not overfetch:
        corpus = corpus.where(matches)
    hits = top_k(queries, corpus, k * overfetch if contains and overfetch else k)
    if contains and overfetch:
        kept = hits.join(corpus.where(matches).select("vec_id"), "vec_id", "left_semi")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
        hits = kept.withColumn("rank", rank).where(F.col("rank") <= k)
    return hits


def projected(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits with what is shown of their chunk (chunk_seq): empty headings, as stores without nulls keep them, are null."""
    shown = chunks.select(F.col("chunk_seq").alias("vec_id"), "source_file", F.nullif("heading", F.lit("")).alias("heading"), "page_start", "text")
    return hits.join(shown, "vec_id")


def any_contains(text: Column, needles: Column) -> Column:
    """Whether a text has any of the needles, letter case aside."""
    return F.exists(needles, lambda n: F.contains(F.lower(text), F.lower(n)))


def needles_found(needles: DataFrame, texts: DataFrame, key: str, text: str = "text", block: int = NEEDLE_BLOCK) -> DataFrame:
    """(key, n): the needles (n) that each text contains, letter case aside, each once for a row.

    The needles are a stated query set: they go over all texts in blocks of at most about `block`, so that what is sent to
    a task is bounded whatever their number. Null and empty needles are in no text.
    """
    wanted = needles.select(F.lower("n").alias("n")).where("n <> ''").distinct()
    parts = max(1, -(-wanted.count() // block))
    dealt = wanted.withColumn("_part", F.pmod(F.xxhash64("n"), F.lit(parts)))
    found = [texts.select(key, F.explode(found_in(F.lower(F.col(text)), sorted(r["n"] for r in dealt.where(F.col("_part") == part).collect()))).alias("n")) for part in range(parts)]
    return reduce(DataFrame.unionByName, found)


def hit_rates(hits: DataFrame, by: str, ks: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """hits (query_id, by, rank, content_hit, source_hit) -> counts and rates for each k, by group and over all ('all')."""
    first = hits.groupBy("query_id", by).agg(F.min(F.when(F.col("content_hit"), F.col("rank"))).alias("content"), F.min(F.when(F.col("source_hit"), F.col("rank"))).alias("source"))
    each = first.select("*", F.explode(F.array(*map(F.lit, ks))).alias("k"))
    ok = lambda c: F.sum((F.coalesce(F.col(c), F.lit(1 << 30)) <= F.col("k")).cast("long"))
    rows = each.groupingSets([["k", by], ["k"]], "k", by).agg(F.count("*").alias("n"), ok("content").alias("content_hits"), ok("source").alias("source_hits"), F.grouping(by).alias("_all"))
    return rows.select(
        F.when(F.col("_all") == 1, "all").otherwise(F.col(by)).alias("section"), "k", "n", "content_hits", "source_hits",
        F.round(F.col("content_hits") / F.col("n"), 4).alias("content_rate"), F.round(F.col("source_hits") / F.col("n"), 4).alias("source_rate"),
    ).orderBy("section", "k")
