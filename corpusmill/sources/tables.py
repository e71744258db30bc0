"""Readers for the corpus tables and for raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table `name` of a data folder. Columns and filters are pruned by the Parquet scan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
