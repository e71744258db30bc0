"""Problem 7: a mix of sources by target shares.

The tokens of every text are counted with a public tokenizer. The largest mix in which every source that has documents
can reach its share follows from what each source holds, times its cap of repeats. It is parted into blocks of equal
tokens, and Sainte-Laguë apportionment (highest quotients w/(2k+1), found through the divisor that gives the same quotas)
gives the blocks to the sources and a source's blocks to its shards, as integers; what a full source or shard cannot take
goes to the others. A shard's documents stand in a seeded order, which is cut into blocks; its quota takes all blocks as
often as it holds them all, and the first ones once more. The document that fits best closes what whole documents leave.
"""

from __future__ import annotations

import base64
import math
import posixpath
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE of that vocabulary splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Blocks of a mix at least, and of a source; shards of a source at most; tokens of a shard and of a stretch of it; targets.
BLOCKS, OF_SOURCE, SHARDS, PER_SHARD, PER_SUB, MAX_SOURCES = 20_000, 200, 64, 2_000_000, 4_000_000, 10_000


@lru_cache(maxsize=2)
def _encoder(name: str, pattern: str):
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, pattern: str = PATTERN, out: str = "n_tokens") -> DataFrame:
    """`df` with the number of tokens of its text; null and empty texts have 0. The vocabulary file is sent to the
    executors."""
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = posixpath.basename(tokenizer)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoder(name, pattern).encode_ordinary
        for batch in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in batch])

    return df.withColumn(out, tokens(F.col(text)))


def sainte_lague(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotients w/(2k+1); ties go to the earlier entry. No entry gets more than its cap.

    The divisor d for which the rounded w/d add up to the seats is found by halving, so that the work does not grow with
    the seats; the few seats that ties leave open are given one by one.
    """
    caps = caps or [seats] * len(weights)
    usable = [i for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    quota = [0] * len(weights)
    seats = min(seats, sum(caps[i] for i in usable))
    if not usable or seats <= 0:
        return quota

    def at(d: float) -> list[int]:
        return [int(min(caps[i], weights[i] / d + 0.5)) if d > 0 else caps[i] for i in usable]

    low, high = min(weights[i] for i in usable) / (4.0 * seats + 4), 4.0 * sum(weights[i] for i in usable)
    for _ in range(200):
        mid = (low + high) / 2
        if sum(at(mid)) >= seats:
            low = mid
        else:
            high = mid
    for i, n in zip(usable, at(high)):
        quota[i] = n
    while (left := seats - sum(quota)) > 0:
        order = sorted((i for i in usable if quota[i] < caps[i]), key=lambda i: (-weights[i] / (2 * quota[i] + 1), i))
        for i in order[:left]:
            quota[i] += 1
    return quota


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER, pattern: str = PATTERN, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(mixture, report).

    mixture: (doc_id, source, n_tokens, shard, block, uses) of each document that is used at least once; block is the
    block of its shard in which its middle lies.
    report: (source_name, target_share, max_repeats, available_tokens, quota_tokens, mixed_tokens, reached_share,
    documents_used, most_uses) for every target, also one without documents (reached_share 0).

    Documents of no target, with null source or without tokens are not used. A target share that is null or not above 0,
    or a cap below 1, takes nothing. Without `total_tokens` the mix is the largest in which each source with documents
    can still hold its share; a larger wish is cut to what the caps allow, so no document is ever used more than
    max_repeats times. Targets named twice count once, by their first row in order of share and cap. Repeated document
    rows are separate documents. Targets must be at most MAX_SOURCES rows (a table of settings; it is checked). A mix has
    at least `blocks` blocks, more where a source holds less than OF_SOURCE of them, and none is below a token.
    """
    rows = targets.select("source_name", F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source_name IS NOT NULL").orderBy("source_name", "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} targets")
    wanted = {}
    for r in rows:
        wanted.setdefault(r[0], (max(0.0, r[1] or 0.0), max(0, r[2] or 0)))
    spark = documents.sparkSession
    known = F.broadcast(spark.createDataFrame([(k,) for k in wanted] or [("",)], "source string"))
    used = documents.select(F.col("doc_id"), F.col("source"), F.col("text")).join(known, "source", "left_semi")
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.coalesce("n_tokens", F.lit(0))), F.lit(1 << 40))
    counted = count_tokens(used, tokenizer=tokenizer, pattern=pattern).drop("text").where("n_tokens > 0")
    counted = cut(counted.withColumns({"place": place, "row": F.monotonically_increasing_id()}), "tokens")

    held = {r[0]: r[1] for r in counted.groupBy("source").agg(F.sum("n_tokens")).collect()}  # at most one row a target
    names = sorted(n for n, (share, cap) in wanted.items() if n in held and share > 0 and cap > 0)
    shares = sum(wanted[n][0] for n in names)
    reach = min((held[n] * wanted[n][1] * shares / wanted[n][0] for n in names), default=0)
    total = min(total_tokens or reach, reach)
    size = max(1, math.floor(min([total / blocks, *(held[n] / OF_SOURCE for n in names)])))
    seats = sainte_lague([wanted[n][0] for n in names], round(total / size), [-(-held[n] * wanted[n][1] // size) for n in names])
    of_source = dict(zip(names, seats))

    shards = {n: max(1, min(SHARDS, held[n] // PER_SHARD)) for n in names}
    subs = {n: max(1, held[n] // shards[n] // PER_SUB) for n in names}
    plan = spark.createDataFrame([(n, int(shards[n]), int(subs[n]), int(wanted[n][1])) for n in names] or [("", 1, 1, 0)], "source string, shards long, subs long, cap int")
    placed = (
        counted.join(F.broadcast(plan), "source")
        .withColumn("shard", F.pmod("place", "shards"))
        .withColumn("sub", F.floor(F.floor(F.col("place") / F.col("shards")) / F.ceil(F.lit(float(1 << 40)) / F.col("shards") / F.col("subs"))))
    )  # sub: bounded stretches of a shard's seeded order
    sums = placed.groupBy("source", "shard", "sub").agg(F.sum("n_tokens").alias("sub_tokens"))
    per_shard = sums.groupBy("source", "shard").agg(F.sum("sub_tokens").alias("shard_tokens")).orderBy("source", "shard").collect()  # at most SHARDS a target
    by_source: dict[str, list] = {}
    for r in per_shard:
        by_source.setdefault(r["source"], []).append(r)
    quotas = []
    for n, own in by_source.items():
        weights, cap = [r["shard_tokens"] for r in own], wanted[n][1]
        for r, q in zip(own, sainte_lague(weights, of_source[n], [-(-w * cap // size) for w in weights])):
            quotas.append((n, int(r["shard"]), q * size, int(r["shard_tokens"])))
    quota = F.broadcast(spark.createDataFrame(quotas or [("", 0, 0, 1)], "source string, shard long, quota long, shard_tokens long"))

    before_sub = Window.partitionBy("source", "shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("sub_offset", F.coalesce(F.sum("sub_tokens").over(before_sub), F.lit(0)))
    inside = Window.partitionBy("source", "shard", "sub").orderBy("place", "doc_id", "n_tokens", "row").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("sub_offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)) + F.col("n_tokens") / 2
    rounds = F.floor(F.col("quota") / F.col("shard_tokens"))
    more = (F.col("middle") < F.col("quota") - rounds * F.col("shard_tokens")).cast("int")
    chosen = (
        placed.join(offsets.drop("sub_tokens"), ["source", "shard", "sub"])
        .withColumn("middle", middle)
        .join(quota, ["source", "shard"])
        .withColumn("uses", F.least(F.col("cap"), (rounds + more)).cast("int"))
        .select("doc_id", "source", "n_tokens", "shard", F.floor(F.col("middle") / F.lit(size)).alias("block"), "uses", "cap", "quota", "row")
    )
    chosen = cut(chosen, "chosen")
    # one document more, or once less, closes the gap of a shard best
    gaps = chosen.groupBy("source", "shard").agg((F.max("quota") - F.sum(F.col("n_tokens") * F.col("uses"))).alias("gap"))
    left = lambda n: F.abs(F.col("gap") - n * F.col("n_tokens"))
    change = F.when((F.col("uses") < F.col("cap")) & (left(1) <= left(-1)), 1).when(F.col("uses") > 0, -1).when(F.col("uses") < F.col("cap"), 1)
    able = chosen.join(F.broadcast(gaps), ["source", "shard"]).withColumn("change", change).where(F.col("change").isNotNull() & (left(F.col("change")) < F.abs("gap")))
    closing = able.groupBy("source", "shard").agg(F.min_by(F.struct("row", "change"), F.struct(left(F.col("change")).alias("left"), "row")).alias("c")).select(F.col("c.row").alias("row"), F.col("c.change").alias("change"))
    uses = F.col("uses") + F.coalesce("change", F.lit(0))
    mixture = chosen.join(F.broadcast(closing), "row", "left").withColumn("uses", uses).where("uses > 0").select("doc_id", "source", "n_tokens", "shard", "block", "uses")
    done = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("mixed_tokens"), F.count("*").alias("documents_used"), F.max("uses").alias("most_uses"))
    listed = spark.createDataFrame([(n, s, c, int(held.get(n, 0)), int(of_source.get(n, 0) * size)) for n, (s, c) in wanted.items()], "source_name string, target_share double, max_repeats int, available_tokens long, quota_tokens long")
    everything = done.agg(F.sum("mixed_tokens").alias("all_tokens"))
    report = (
        listed.join(done.withColumnRenamed("source", "source_name"), "source_name", "left")
        .crossJoin(F.broadcast(everything))  # one row
        .select(
            "source_name", "target_share", "max_repeats", "available_tokens", "quota_tokens", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("reached_share"), F.coalesce("documents_used", F.lit(0)).alias("documents_used"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
        )
    )
    return mixture, report
