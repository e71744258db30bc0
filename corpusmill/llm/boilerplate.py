"""Problem 4: blocks of lines that one site repeats over many of its files.

Every line gets the identifier of its wording. The lines of a site's files, each file in order of its chunks, are one
sequence of identifiers with an end after each file. The suffixes of that sequence are ranked by prefix doubling, as
Spark joins and groupings: suffixes with the same first 1, 2, 4, ... identifiers form an interval of the suffix array, and
the rank is the place at which the interval begins. Intervals that span too few files of their site are not refined any
further, as no longer common prefix can span more. Going back down through the levels gives every suffix the exact length
of the longest prefix it has in common with suffixes of enough files. Prefixes that no longer one to their left covers are
the repeated blocks; the lines inside the blocks are listed and deleted.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import clean_path, site_of
from .lookalike import TABLE, fold
from .shared import cut, looked_up

SHARE, LEAST_FILES = 0.1, 4
#: Seed of Spark's xxhash64; identifiers are made by it and in Python alike.
SEED = 42
_NOT_LETTER = re.compile(r"[\W\d_]+")
_OTHER_LETTER = re.compile("[" + "".join(chr(c) for c in range(0x370, 0x530) if c not in TABLE) + "]")
_LATIN = re.compile(r"[A-Za-zÀ-ʯ]")
_MARKED = re.compile("[\u0300-\u036f\u0600-\u06ff\u0900-\u0dff]")


def wording(line: str) -> str:
    """What is left of a line apart from look-alikes, digits, letter case, spacing, punctuation and symbols."""
    if line.isascii():
        return _NOT_LETTER.sub("", line).lower()
    folded = fold(line).lower()
    if _OTHER_LETTER.search(line):  # a line that is written in another script
        folded = " ".join(fold(w).lower() if _LATIN.search(w) else fold(w.lower()) for w in line.split())
    folded = unicodedata.normalize("NFC", folded)
    if _MARKED.search(folded):
        return "".join(c for c in folded if unicodedata.category(c)[0] in "LM")
    return _NOT_LETTER.sub("", folded)


def identifier(line: str) -> int | None:
    """The identifier of a line's wording, as Spark's xxhash64 gives it; None for a line without letters."""
    w = wording(line)
    if not w:
        return None
    h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), SEED)
    return h - (1 << 64) if h >= 1 << 63 else h


def lines_of(df: DataFrame, key: str = "chunk_seq", text: str = "text", path: str = "source_file") -> DataFrame:
    """(key, site, file, lines): line number and identifier of each text's lines with letters, in order.

    Texts of ASCII characters only are dealt with in the JVM, by the same rule.
    """

    @F.pandas_udf("array<long>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int | None] = {}
        for batch in batches:
            if len(known) > 200_000:
                known.clear()
            out = []
            for t in batch:
                if not t:
                    out.append(None)
                    continue
                row = []
                for x in t.split("\n"):
                    if x not in known:
                        known[x] = identifier(x)
                    row.append(known[x])
                out.append(row)
            yield pd.Series(out)

    body = F.col("_text")
    plain = ~body.rlike(r"[^\x00-\x7f]")
    letters = F.transform(F.split(body, "\n", -1), lambda x: F.lower(F.regexp_replace(x, "[^A-Za-z]+", "")))
    numbers = F.when(plain, F.transform(letters, lambda w: F.when(w != "", F.xxhash64(w)))).otherwise(F.col("_ids"))
    numbered = F.filter(F.transform(numbers, lambda x, i: F.struct((i + 1).cast("int").alias("line_no"), x.alias("id"))), lambda s: s["id"].isNotNull())
    slim = df.select(F.col(key).alias("_key"), site_of(F.col(path)).alias("site"), F.xxhash64(clean_path(F.col(path))).alias("file"), F.col(text).alias("_text"))
    read = slim.where("site IS NOT NULL").withColumn("_ids", ids(F.when(~plain, body)))
    return read.select("_key", "site", "file", F.coalesce(numbered, F.array().cast("array<struct<line_no:int,id:bigint>>")).alias("lines"))


def sequences(df: DataFrame, key: str = "chunk_seq", text: str = "text", path: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """((site, file, pos, id, _key, line_no), (site, needed files)): the lines of each site's files one after the other.

    A file's rows are dealt over ranges of their key, so that a file of any size is numbered by many tasks: inside each
    range first, then by what the ranges before it hold.
    """
    read = cut(lines_of(df, key, text, path), "line-ids")
    sizes = read.groupBy("site").agg(F.countDistinct("file").alias("files"))
    ranged = read.where(F.size("lines") > 0).repartitionByRange("site", "file", "_key").withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("site", "file", "_part").orderBy("_key", "lines").rowsBetween(Window.unboundedPreceding, -1)
    begun = cut(ranged.withColumn("_before", F.coalesce(F.sum(F.size("lines")).over(inside), F.lit(0))), "sequence")
    held = begun.groupBy("site", "file", "_part").agg(F.sum(F.size("lines")).alias("_n"))
    before = Window.partitionBy("site", "file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = begun.join(offsets, ["site", "file", "_part"])
    lines = placed.select("site", "file", "_key", (F.col("_offset") + F.col("_before")).alias("_at"), F.posexplode("lines").alias("_i", "_line"))
    return lines.select("site", "file", (F.col("_at") + F.col("_i")).alias("pos"), "_line.id", "_key", "_line.line_no"), sizes


def _intervals(places: DataFrame, needed: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Intervals of the suffix array that span enough files, and their number, out of (site, length, rank, next, file).

    An interval is told by the one it refines (length, rank) and what follows (`next`). `new_rank` is the place of its
    first suffix among the suffixes that are kept. Files are told apart before they are counted, so that a hot interval
    is aggregated inside the tasks first. A file is in few intervals that span a tenth of all files, so the intervals of
    a site are about ten times as many as a file has different lines.
    """
    of_file = places.groupBy("site", "length", "rank", "next", "file").agg(F.count("*").alias("n"))
    spans = of_file.groupBy("site", "length", "rank", "next").agg(F.count("*").alias("block_files"), F.sum("n").alias("suffixes"))
    wide = spans.join(needed, "site").where("block_files >= needed")
    before = Window.partitionBy("site", "length", "rank").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
    kept = wide.select("site", "length", "rank", "next", "block_files", (F.col("rank") + F.coalesce(F.sum("suffixes").over(before), F.lit(0))).alias("new_rank"))
    written = cut(kept, name)
    return written, written.count()


def common_prefixes(lines: DataFrame, needed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, lines of the suffixes that have one): for each suffix the length in lines of the longest prefix that
    enough files of its site have, with the rank of its interval and the number of those files."""
    on = ["site", "length", "rank", "next"]
    start = lines.withColumns({"length": F.lit(0), "rank": F.lit(0).cast("long"), "next": F.col("id")})
    kept, n = _intervals(start, needed, "intervals-1")
    spread = F.col("pos")
    level = cut(looked_up(start, kept, on, spread, n).select("site", "file", "pos", "_key", "line_no", F.col("new_rank").alias("rank"), "block_files"), "ranks-1")
    members, levels, length = level, [level.select("site", "file", "pos", "rank", "block_files")], 1

    def beside(state: DataFrame, step: DataFrame, how: str) -> DataFrame:
        """The rank of what stands after each prefix of `state`."""
        after = step.select("file", F.col("pos").alias("_at"), F.col("rank").alias("next"))
        return state.withColumn("_at", F.col("pos") + F.col("length")).join(after, ["file", "_at"], how).drop("_at")

    while n:  # double until no interval spans enough files
        places = cut(beside(levels[-1].withColumn("length", F.lit(length)), levels[-1], "inner"), "places")
        kept, n = _intervals(places, needed, f"intervals-{2 * length}")
        if n:
            found = looked_up(places.drop("block_files"), kept, on, spread, n)
            levels.append(cut(found.select("site", "file", "pos", F.col("new_rank").alias("rank"), "block_files"), f"ranks-{2 * length}"))
            length *= 2
    state = levels.pop().withColumn("length", F.lit(length))
    while levels:  # go back: try to lengthen each prefix by half the step before
        step, half = levels.pop(), length // 2
        places = cut(beside(state, step, "left"), "places")
        kept, n = _intervals(places.where("next IS NOT NULL"), needed, f"intervals-{length}-{half}")
        longer = looked_up(places, kept.withColumnRenamed("block_files", "_files"), on, spread, n, "left")
        told = longer.select(
            "site", "file", "pos", F.coalesce("new_rank", "rank").alias("rank"), F.coalesce("_files", "block_files").alias("block_files"),
            F.when(F.col("new_rank").isNotNull(), F.col("length") + F.lit(half)).otherwise(F.col("length")).alias("length"),
        )
        rest = step.join(state.select("file", "pos"), ["file", "pos"], "left_anti").withColumn("length", F.lit(half))
        state = cut(told.unionByName(rest), "prefixes")
        length = half
    return state, members


def repeated_blocks(df: DataFrame, key: str = "chunk_seq", text: str = "text", path: str = "source_file", share: float = SHARE, least_files: int = LEAST_FILES) -> DataFrame:
    """(key, line_no, site, block_lines, block_files): every line of a block that at least `share` of its site's files
    and no fewer than `least_files` hold.

    line_no counts from 1. block_lines is the exact length of the longest such block that covers the line, in lines that
    hold letters; others neither count nor part a block. block_files is the number of files with that block. A block may
    run over the end of a chunk into the next chunk of the file, never over the end of a file. A null path has site null
    and no lines; null and empty texts have none. Repeated rows keep their own lines; repeated files count once.
    """
    lines, sizes = sequences(df, key, text, path)
    needed = sizes.select("site", F.greatest(F.ceil(F.col("files") * F.lit(share) - 1e-9), F.lit(least_files)).alias("needed"))
    prefixes, members = common_prefixes(lines, needed)
    before = prefixes.select("file", (F.col("pos") + 1).alias("pos"), F.col("length").alias("_left"))
    blocks = prefixes.join(before, ["file", "pos"], "left").where("_left IS NULL OR _left <= length")
    covered = blocks.select("file", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length") - 1)).alias("pos"), F.struct("length", "block_files").alias("_block"))
    longest = members.join(covered, ["file", "pos"]).groupBy("_key", "line_no", "site").agg(F.max("_block").alias("_block"))
    return longest.select(F.col("_key").alias(key), "line_no", "site", F.col("_block.length").cast("int").alias("block_lines"), "_block.block_files")


def without_repeated(df: DataFrame, key: str = "chunk_seq", text: str = "text", path: str = "source_file", **limits) -> DataFrame:
    """(key, text, removed): the texts without their site's repeated blocks; untouched where none is listed.

    A text that consists of such lines only becomes empty; null stays null.
    """
    lines = repeated_blocks(df, key, text, path, **limits).groupBy(key).agg(F.collect_set("line_no").alias("_drop"))
    slim = df.select(F.col(key), F.col(text).alias("_text"))
    kept = F.filter(F.split("_text", "\n", -1), lambda x, i: ~F.array_contains(F.col("_drop"), (i + 1).cast("int")))
    return slim.join(lines, key, "left").select(key, F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("_drop"), F.lit(0)).alias("removed"))
