from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import shared
from corpusmill.sources import scratch


def test_look_ups_with_hot_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    for how in ("inner", "left"):
        small = shared.looked_up(left, right, ["k"], F.col("i"), 3, how)
        salted = shared.looked_up(left, right, ["k"], F.col("i"), shared.BROADCAST_ROWS + 1, how)
        assert salted.columns == small.columns and sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)


def test_slices_are_bounded_and_whole():
    batch = pd.DataFrame({"t": ["x" * 10, None, "y" * 95, "", "z" * 30, "w" * 80]})
    parts = list(shared.slices(batch, "t", 100))
    assert pd.concat(parts).equals(batch) and all(len(p) == 1 or p["t"].fillna("").map(len).sum() <= 100 for p in parts)
    assert list(shared.slices(batch.iloc[:0], "t")) == []


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        scratch.shared_folder(Session)
