"""Which of many needles a text contains, in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def found_in(text: Column, needles: list[str]) -> Column:
    """The distinct needles in a text as an array; null texts have none."""

    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for n in needles:
            if n:
                automaton.add_word(n, n)
        automaton.make_automaton()
        for batch in batches:
            if len(automaton):
                yield pd.Series([sorted({n for _, n in automaton.iter(t)}) if t else [] for t in batch])
            else:
                yield pd.Series([[] for _ in batch])

    return find(text)
