"""Where tables go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.incremental import remaining


def append_cache(pages: DataFrame, path: str, key: str = "source_rel") -> None:
    """Extraction results, keyed by the hash of the relative path."""
    pages.withColumn("cache_key", F.sha1(key)).write.mode("append").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def rebuild(rows: DataFrame, path: str, kind: str = "json") -> None:
    """Chunks or links, written anew as a whole."""
    rows.write.mode("overwrite").format(kind).save(path)


def load_vectors(vectors: DataFrame, path: str, key: str = "chunk_id", resume: bool = False) -> None:
    """Vectors written anew, or only those whose key the store does not have yet."""
    if not resume:
        vectors.write.mode("overwrite").parquet(path)
        return
    have = vectors.sparkSession.read.parquet(path).select(key)
    remaining(vectors, have, key).write.mode("append").parquet(path)


def report(rows: DataFrame, path: str, dated: bool = False) -> None:
    """Rows as JSON documents, one a line, with the time of writing where asked for."""
    rows = rows.withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")) if dated else rows
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "\t").csv(path)
