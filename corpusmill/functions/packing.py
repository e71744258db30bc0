"""Packing of sentences, paragraphs and table rows under a size cap, as small per-text helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITE, strip

MAX_CHARS = 1600
_PARAGRAPH, _SENTENCE = re.compile(r"\n\s*\n"), re.compile(r"(?<=[.?!])\s+")


def pack(units: Iterable[str], joint: str, cap: int, oversize: Callable[[str], Iterable[str]]) -> Iterator[str]:
    """Greedy: a unit joins the buffer while buffer + unit + 1 fits; an oversize unit flushes it and is split by itself.

    Units are taken as they come and pieces given as they are full, so a stream of units of any length can be packed.
    """
    buffer = ""
    for unit in units:
        if len(unit) > cap:
            if buffer:
                yield buffer
            yield from oversize(unit)
            buffer = ""
        elif len(buffer) + len(unit) + 1 <= cap:
            buffer = f"{buffer}{joint}{unit}" if buffer else unit
        else:
            if buffer:
                yield buffer
            buffer = unit
    if buffer:
        yield buffer


def hard_split(text: str, cap: int = MAX_CHARS) -> list[str]:
    """By single spaces; a word above the cap is sliced."""
    return list(pack((w for w in text.split(" ") if w), " ", cap, lambda w: [w[i : i + cap] for i in range(0, len(w), cap)]))


def sentences(lines: Iterable[str]) -> Iterator[str]:
    """Sentences of lines that are joined by line ends, as the lines come."""
    open_: list[str] = []
    for line in lines:
        parts = _SENTENCE.split(line)
        if open_ and open_[-1].endswith((".", "?", "!")):
            yield "\n".join(open_)
            open_ = []
        for part in parts[:-1]:
            yield "\n".join([*open_, part])
            open_ = []
        open_.append(parts[-1])
    if open_:
        yield "\n".join(open_)


def pack_sentences(text: str, cap: int = MAX_CHARS) -> list[str]:
    return list(pack((s for s in _SENTENCE.split(text) if s), " ", cap, lambda s: hard_split(s, cap)))


def section_pieces(lines: Iterator[str], cap: int = MAX_CHARS) -> Iterator[str]:
    """Pieces of a section's lines: all of them where they fit, else their sentences packed."""
    held, size = [], -1
    for line in lines:
        held.append(line)
        size += len(line) + 1
        if size > cap:
            yield from pack((s for s in sentences(chain(held, lines)) if s), " ", cap, lambda s: hard_split(s, cap))
            return
    if held:
        yield "\n".join(held)


def split_text(text: str, cap: int = MAX_CHARS) -> list[str]:
    """Paragraphs packed with line ends; a paragraph above the cap is packed by its sentences."""
    paragraphs = (p.strip() for p in _PARAGRAPH.split(text))
    return list(pack((p for p in paragraphs if p), "\n", cap, lambda p: pack_sentences(p, cap)))


def pack_table(rows: list[str], cap: int = MAX_CHARS) -> list[str]:
    """The header row on each piece; a single row above the cap is kept whole, so the cap is not sure for tables."""
    if not rows:
        return []
    header, body = rows[0], rows[1:]
    if sum(len(r) + 1 for r in rows) <= cap or not body:
        return ["\n".join(rows)]
    out, held, size = [], [], len(header)
    for row in body:
        if held and size + len(row) + 1 > cap:
            out.append("\n".join([header, *held]))
            held, size = [], len(header)
        held.append(row)
        size += len(row) + 1
    return [*out, "\n".join([header, *held])]


def pieces(text: Column, cap: int = MAX_CHARS) -> Column:
    """The pieces of a text as an array; null and blank texts have none.

    A text within the cap that has no blank line is its own piece and stays in the JVM.
    """

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([split_text(t, cap) if t else [] for t in batch])

    bare = strip(text)
    whole = (F.length(bare) <= cap) & ~text.rlike(rf"\n[{WHITE}]*\n")
    kept = F.when(F.length(bare) > 0, F.array(bare)).otherwise(F.array().cast("array<string>"))
    return F.when(F.coalesce(whole, F.lit(False)), kept).otherwise(split(F.when(~F.coalesce(whole, F.lit(False)), text)))


def table_pieces(rows: Column, cap: int = MAX_CHARS) -> Column:
    """The pieces of an array of row texts."""

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([pack_table(list(r), cap) if r is not None else [] for r in batch])

    return split(rows)
