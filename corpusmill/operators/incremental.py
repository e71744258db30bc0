"""Work that is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame


def remaining(work: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of `work` whose key `done` does not have."""
    keys = [key] if isinstance(key, str) else key
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
