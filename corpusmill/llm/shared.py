"""Small helpers of the subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch

#: Rows up to which a written table is broadcast in a look-up, and parts that the other side is dealt over beyond.
BROADCAST_ROWS, SALTS = 100_000, 16


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder in spark.checkpoint.dir and read them again.

    `sources.scratch.release` removes what was written, once the results have been read.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(left: DataFrame, right: DataFrame, on: list[str], spread: Column, rows: int, how: str = "inner") -> DataFrame:
    """Join with a table of `rows` distinct keys of which some may be very frequent on the left.

    Up to BROADCAST_ROWS rows it is broadcast; a larger one is copied SALTS times and the left rows are dealt over the
    copies by `spread`, so that the rows of a hot key are shared by SALTS tasks.
    """
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def slices(batch: pd.DataFrame, text: str, characters: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """A batch in parts of about so many characters, so that what is held at once does not depend on the rows' lengths;
    a longer text is a part by itself."""
    begin, held = 0, 0
    for i, t in enumerate(batch[text]):
        n = len(t) if t else 0
        if i > begin and held + n > characters:
            yield batch.iloc[begin:i]
            begin, held = i, 0
        held += n
    if begin < len(batch):
        yield batch.iloc[begin:]
