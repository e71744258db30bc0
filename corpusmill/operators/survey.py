"""What a corpus holds: extensions, sizes, histograms, largest files, samples, extraction logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import suffix

# Upper ends of the page-count buckets and their names.
BUCKETS = ((20, "0-20"), (50, "21-50"), (100, "51-100"), (300, "101-300"), (600, "301-600"), (None, "601+"))


def extension_census(files: DataFrame, path: str, size: str) -> DataFrame:
    """Files and bytes of each extension and, as 'all', of everything."""
    rows = files.select(suffix(F.col(path)).alias("ext"), F.col(size).alias("_size")).rollup("ext").agg(F.count("*").alias("files"), F.coalesce(F.sum("_size"), F.lit(0)).alias("total"))
    return rows.select(F.coalesce("ext", F.lit("all")).alias("ext"), "files", F.col("total").cast("long").alias("total")).orderBy(F.desc("files"), "ext")


def bucket(pages: Column) -> Column:
    out = F.when(pages <= BUCKETS[0][0], BUCKETS[0][1])
    for top, name in BUCKETS[1:-1]:
        out = out.when(pages <= top, name)
    return out.otherwise(BUCKETS[-1][1])


def page_histogram(files: DataFrame, pages: str) -> DataFrame:
    """Files and pages of each bucket, empty buckets too."""
    spark = files.sparkSession
    names = spark.createDataFrame([(i, n) for i, (_, n) in enumerate(BUCKETS)], "bucket_no int, bucket string")
    held = files.where(F.col(pages).isNotNull()).groupBy(bucket(F.col(pages)).alias("bucket")).agg(F.count("*").alias("files"), F.sum(pages).cast("long").alias("pages"))
    return names.join(held, "bucket", "left").select("bucket_no", "bucket", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("pages", F.lit(0)).alias("pages"))


def census(files: DataFrame, pages: str = "n_pages", error: str = "error") -> DataFrame:
    """One row: files whose pages were counted, their pages, and files that could not be read."""
    counted = F.col(error).isNull() & F.col(pages).isNotNull()
    return files.agg(F.count_if(counted).alias("files"), F.coalesce(F.sum(F.when(counted, F.col(pages))), F.lit(0)).cast("long").alias("pages"), F.count_if(F.col(error).isNotNull()).alias("errors"))


def largest(files: DataFrame, count: str, key: str, n: int = 25) -> DataFrame:
    return files.select(key, count).orderBy(F.desc(count), F.desc(key)).limit(n)


def seeded_sample(files: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The same n rows for the same seed, in whatever order they are read."""
    return files.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), key).limit(n)


def latest_log(log: DataFrame, path: str = "path") -> DataFrame:
    """The last row of each file in an append-only log with retries and repeated rows."""
    last = F.struct(F.coalesce(F.col("logged_at"), F.lit("1970-01-01").cast("timestamp")).alias("at"), "log_id")
    return log.groupBy(path).agg(F.max_by(F.struct("log_id", "status", "n_pages", "error", "elapsed_s", F.coalesce(F.size("extract_errors"), F.lit(0)).alias("n_errors")), last).alias("l"), F.count("*").alias("tries")).select(path, "tries", "l.*")


def observed(rows: DataFrame, status: str = "status") -> tuple[DataFrame, Observation]:
    """`rows` with counters of its good and failed rows, filled as whatever reads it runs; no job of its own."""
    counters = Observation()
    failed = F.coalesce(F.col(status) != "ok", F.lit(True))
    return rows.observe(counters, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed")), counters
