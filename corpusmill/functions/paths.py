"""Column helpers for file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_path(path: Column) -> Column:
    """One way of writing a path: `/` separators, no doubled `/`, no leading `./` or `/`. Null stays null."""
    slashed = F.regexp_replace(F.trim(path), r"[\\/]+", "/")
    return F.regexp_replace(slashed, r"^(\./|/)+", "")


def site_of(path: Column) -> Column:
    """First folder of a path once it is written in one way; the file name itself where there is no folder."""
    return F.element_at(F.split(clean_path(path), "/"), 1)
