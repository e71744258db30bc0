"""Chunks that keep arriving: new ones are added once, however often they are delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import remaining


def ingest_new(spark: SparkSession, source: str, target: str, checkpoint: str, key: str = "chunk_id", order: str | None = None) -> StreamingQuery:
    """Stream Parquet files of chunks into `target`, each key once.

    Of several deliveries in one micro-batch the first by `order` stays (without it, the least row); then it is cut to
    the keys that the target does not have, of which only the key column is read. A batch that is run again after a
    failure finds its own rows there and adds nothing.
    """
    schema = spark.read.parquet(source).schema

    def add(batch: DataFrame, number: int) -> None:
        row = F.struct("*")
        fresh = batch.groupBy(key).agg((F.min_by(row, order) if order else F.min(row)).alias("_row")).select("_row.*")
        try:
            fresh = remaining(fresh, spark.read.parquet(target).select(key), key)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_status(log: DataFrame, late_by: str = "1 hour") -> DataFrame:
    """Files of each status in windows of an hour; rows later than the watermark are left out of a stream."""
    return log.withWatermark("logged_at", late_by).groupBy(F.window("logged_at", "1 hour"), "status").agg(F.count("*").alias("files")).select(F.col("window.start").alias("hour"), "status", "files")
