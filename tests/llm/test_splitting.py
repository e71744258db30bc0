from __future__ import annotations

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import splitting


def check(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    parts = splitting.cuts(text, limit, overlap)
    assert "".join(text[n:e] for _, n, e in parts) == text
    assert all(e - s <= limit and 0 <= n - s <= overlap for s, n, e in parts)
    assert all(e > n for _, n, e in parts) or not text
    assert all(b[1] == a[2] for a, b in zip(parts, parts[1:]))
    return parts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n!é́क्षि‍👍", max_size=400), st.integers(20, 80))
def test_pieces_make_up_the_text(text, limit):
    check(text, limit, limit // 4)


def test_cuts_stand_at_sentence_ends():
    r = random.Random(1)
    text = " ".join(" ".join(r.choice("alpha beta gamma delta river stone".split()) for _ in range(12)).capitalize() + "." for _ in range(200))
    parts = check(text, 1600, 150)
    assert all(text[e - 2 : e] == ". " for _, _, e in parts[:-1])
    assert all(text[s].isupper() for s, _, _ in parts)


def test_cut_goes_to_the_change_of_topic():
    a, b = "The boiler holds warm water near pipes. ", "Quiet essays praise distant wilderness gently. "
    parts = check(a * 20 + b * 30, 1600, 150)
    assert parts[0][2] == len(a) * 20


def test_words_and_characters_when_there_is_no_sentence():
    text = "word " * 1000
    assert all(text[e - 1] == " " for _, _, e in check(text, 1600, 150)[:-1])
    marks = "é" * 3000
    assert all(unicodedata.category(marks[e]) != "Mn" for _, _, e in check(marks, 1600, 150)[:-1])
    assert len(check("x" * 50_000, 1600, 150)) > 30


def test_operator(spark):
    data = [(1, "H", "a" * 1600), (2, None, "b " * 1000), (3, "H", None), (4, "", ""), (2, "again", "b " * 1000)]
    df = spark.createDataFrame(data, "chunk_seq long, heading string, text string").selectExpr("*", "1 AS piece_no", "2 AS char_count", "3 AS _key")
    got = splitting.split_oversized(df).collect()
    assert [r for r in got if r["chunk_seq"] == 3][0]["text"] is None and [r for r in got if r["chunk_seq"] == 4][0]["char_count"] == 0
    assert all(r["char_count"] == len(r["text"] or "") for r in got)
    assert {(r["chunk_seq"], r["heading"]) for r in got if r["n_pieces"] > 1} == {(2, None), (2, "again")}
    assert splitting.split_oversized(df.where("false")).count() == 0


@pytest.mark.parametrize("size", [1599, 1600, 1601, 3200])
def test_limit(size):
    assert (len(splitting.cuts("y" * size)) > 1) == (size > 1600)
