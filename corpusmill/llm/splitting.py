"""Problem 1: cut oversized texts into pieces at natural boundaries.

Lexical-cohesion segmentation: the words of the sentences just before and just after every sentence end are compared
(cosine of word counts in sliding blocks). Where the similarity forms a valley the topic changes. Each piece ends at the
deepest valley in the part of the text that still fits; a paragraph end counts as a little deeper. Where no sentence
ends there, the last word end is taken, and where there is none, the last place that does not tear a character from its
marks. Every piece but the first starts with up to `overlap` characters of the end of the piece before it.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT, OVERLAP, BLOCK = 1600, 150, 3
PARAGRAPH_BONUS = 0.3

_END = re.compile(r"\n[ \t]*\n\s*|\n\s*|[.?!…][\"'”’)\]]*\s+|[.?!][\"'”’)\]]*(?=[^\W\d_a-z])|[।॥。！？]\s*")
_WORD = re.compile(r"[^\W\d_]{3,}")
_SPACE = re.compile(r"\s+")


def boundaries(text: str) -> tuple[list[int], list[float]]:
    """Positions after which a paragraph or sentence has ended, and what its kind adds to the depth."""
    at, bonus = [], []
    for m in _END.finditer(text):
        if 0 < m.end() < len(text):
            at.append(m.end())
            bonus.append(PARAGRAPH_BONUS if "\n" in m[0] else 0.0)
    return at, bonus


def _cosine(a: Counter, b: Counter, na: float, nb: float) -> float:
    if not na or not nb:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    return sum(n * b[w] for w, n in a.items() if w in b) / math.sqrt(na * nb)


def depths(text: str, at: list[int], block: int = BLOCK) -> list[float]:
    """Depth of the similarity valley at each boundary: how far both sides rise above it."""
    edges = [0, *at, len(text)]
    bags = [Counter(w.lower() for w in _WORD.findall(text, s, e)) for s, e in zip(edges, edges[1:])]
    similarity = []
    for i in range(1, len(bags)):
        left, right = Counter(), Counter()
        for bag in bags[max(0, i - block) : i]:
            left.update(bag)
        for bag in bags[i : i + block]:
            right.update(bag)
        similarity.append(_cosine(left, right, sum(n * n for n in left.values()), sum(n * n for n in right.values())))
    n = len(similarity)
    rise_left, rise_right = similarity[:], similarity[:]  # top of the slope that leads down to each place
    for i in range(1, n):
        rise_left[i] = rise_left[i - 1] if similarity[i - 1] >= similarity[i] else similarity[i]
    for i in range(n - 2, -1, -1):
        rise_right[i] = rise_right[i + 1] if similarity[i + 1] >= similarity[i] else similarity[i]
    return [rise_left[i] + rise_right[i] - 2 * similarity[i] for i in range(n)]


def _whole(text: str, at: int, low: int) -> int:
    """The last place up to `at` (but after `low`) that does not part a character from its marks."""
    to = at
    while to > low and (unicodedata.category(text[to])[0] == "M" or text[to] in "\u200c\u200d" or text[to - 1] == "\u200d"):
        to -= 1
    return to if to > low else at


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP, block: int = BLOCK) -> list[tuple[int, int, int]]:
    """(start, cut before which nothing is new, end) of each piece; the pieces' new parts make up the text."""
    if len(text) <= limit:
        return [(0, 0, len(text))]
    at, bonus = boundaries(text)
    score = [d + b for d, b in zip(depths(text, at, block), bonus)]
    words = [m.end() for m in _SPACE.finditer(text)]
    out, start, new = [], 0, 0
    while len(text) - start > limit:
        low, high = new + max(1, (limit - (new - start)) // 3), start + limit
        i, j = bisect_left(at, low), bisect_right(at, high)
        if i < j:
            end = at[max(range(i, j), key=lambda k: (score[k], k))]
        elif (k := bisect_right(words, high) - 1) >= 0 and words[k] >= low:
            end = words[k]
        else:
            end = _whole(text, high, new)
        out.append((start, new, end))
        start, new = _overlap_start(text, at, words, end, overlap, out[-1][1]), end
    return [*out, (start, new, len(text))]


def _overlap_start(text: str, at: list[int], words: list[int], end: int, overlap: int, least: int) -> int:
    """Where the repeated end of a piece begins: at a sentence, else a word, within `overlap` characters."""
    low = max(end - overlap, least)
    for places in (at, words):
        i = bisect_left(places, low)
        if i < len(places) and places[i] < end:
            return places[i]
    to = low
    while to < end and unicodedata.category(text[to])[0] == "M":
        to += 1
    return to


def split_oversized(df: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, block: int = BLOCK, key: str = "chunk_seq", text: str = "text", heading: str = "heading") -> DataFrame:
    """Pieces of every text above `limit` characters; texts within the limit come out as their one piece.

    Returns (key, piece_no from 0, n_pieces, heading, text, char_count, overlap_chars). A null text gives one piece with
    null text and char_count 0; an empty text one empty piece; other columns are left behind, so clashing names do no
    harm. Repeated rows are each split. The texts within the limit never leave the JVM.
    """
    slim = df.select(F.col(key).alias("_key"), F.col(heading).cast("string").alias("_heading"), F.col(text).alias("_text"))
    kind = slim.schema["_key"].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("piece_no", T.IntegerType()),
            T.StructField("n_pieces", T.IntegerType()),
            T.StructField("heading", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("char_count", T.IntegerType()),
            T.StructField("overlap_chars", T.IntegerType()),
        ]
    )

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, h, t in zip(batch["_key"], batch["_heading"], batch["_text"]):
                parts = cuts(t, limit, overlap, block)
                rows += [(k, i, len(parts), h, t[s:e], e - s, n - s) for i, (s, n, e) in enumerate(parts)]
            yield pd.DataFrame(rows, columns=schema.names)

    long = F.length("_text") > limit
    whole = slim.where(~F.coalesce(long, F.lit(False))).select(
        F.col("_key").alias(key), F.lit(0).alias("piece_no"), F.lit(1).alias("n_pieces"), F.col("_heading").alias("heading"), F.col("_text").alias("text"),
        F.coalesce(F.length("_text"), F.lit(0)).alias("char_count"), F.lit(0).alias("overlap_chars"),
    )
    return slim.where(long).mapInPandas(pieces, schema).unionByName(whole)
