"""Exact duplicates of chunks, aliases of files, and links carried over to the surviving files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import clean_path


def canonical_order(path: Column) -> list[Column]:
    """Fewest folders first, then the shortest, then the smallest path."""
    return [F.regexp_count(path, F.lit("/")), F.length(path), path]


def winners(chunks: DataFrame) -> DataFrame:
    """Each chunk with `winner`, the file whose copy of its text survives, and `survives`.

    The text's hash is shuffled, not the text; the argmin is aggregated before the shuffle, so a text that a third of all
    chunks share goes over the network once a task.
    """
    keyed = chunks.select("chunk_seq", clean_path(F.col("source_file")).alias("source_file"), F.coalesce(F.sha1("text"), F.lit("")).alias("hash"))  # null texts are one text
    rank = F.struct(*[c.alias(f"r{i}") for i, c in enumerate([*canonical_order(F.col("source_file")), F.col("chunk_seq")])])
    best = keyed.groupBy("hash").agg(F.min(rank).alias("best"))
    return keyed.join(best, "hash").select("chunk_seq", "source_file", "hash", F.col("best.r2").alias("winner"), (F.col("best.r3") == F.col("chunk_seq")).alias("survives"))


def survivors(chunks: DataFrame) -> DataFrame:
    """One chunk for each distinct text."""
    return winners(chunks).where("survives").select("chunk_seq", "source_file")


def aliases(won: DataFrame) -> DataFrame:
    """(original_file, winner_file): the file most of a file's texts went to, the first seen where several are; only other files."""
    votes = won.groupBy("source_file", "winner").agg(F.count("*").alias("votes"), F.min("chunk_seq").alias("first"))
    top = votes.groupBy("source_file").agg(F.max_by("winner", F.struct("votes", -F.col("first"))).alias("winner_file"))
    return top.where("winner_file <> source_file").select(F.col("source_file").alias("original_file"), "winner_file")


def remap_links(links: DataFrame, alias: DataFrame) -> DataFrame:
    """Links (path, role, linked_to, match_type, link_no) between surviving files: both ends go through the alias once,
    links of a file with itself are dropped, and of several links of one file the last stays."""
    a, b = alias.select(F.col("original_file").alias("path"), F.col("winner_file").alias("_p")), alias.select(F.col("original_file").alias("linked_to"), F.col("winner_file").alias("_l"))
    moved = links.join(a, "path", "left").join(b, "linked_to", "left").select(F.coalesce("_p", "path").alias("path"), "role", F.coalesce("_l", "linked_to").alias("linked_to"), "match_type", "link_no")
    last = moved.where("path <> linked_to").groupBy("path").agg(F.max_by(F.struct("role", "linked_to", "match_type"), "link_no").alias("l"))
    return last.select("path", "l.*")


def annotate(chunks: DataFrame, links: DataFrame) -> DataFrame:
    """Chunks with qa_role and linked_source of their file."""
    ends = links.select(F.col("path").alias("source_file"), F.col("role").alias("qa_role"), F.col("linked_to").alias("linked_source"))
    return chunks.join(ends, "source_file", "left")


def chunk_stats(won: DataFrame, chunks: DataFrame, links: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """One row: raw, kept and dropped chunks, the longest text, linked chunks and linked files and, with the links as they
    were given, how many of them start at a file that gave way to another."""
    kept = won.where("survives").join(chunks.select("chunk_seq", F.length("text").alias("size")), "chunk_seq")
    linked = annotate(kept, links)
    stats = linked.agg(
        F.count("*").alias("total_chunks"), F.max("size").cast("long").alias("max_chars"), F.count("linked_source").alias("linked_chunks"),
        F.countDistinct(F.when(F.col("linked_source").isNotNull(), F.col("source_file"))).alias("linked_files"),
    ).crossJoin(won.agg(F.count("*").alias("raw_chunks"))).withColumn("dropped_chunks", F.col("raw_chunks") - F.col("total_chunks"))  # one row each
    if given is None:
        return stats
    moved = given.join(aliases(won).select(F.col("original_file").alias("path")), "path", "left_semi")
    return stats.crossJoin(moved.agg(F.countDistinct("path").alias("aliased_links")))  # one row each


def store_order(chunks: DataFrame) -> DataFrame:
    """The order of the chunk store: file, page (null as 0), chunk_id as a string."""
    return chunks.orderBy("source_file", F.coalesce("page_start", F.lit(0)), "chunk_id")
