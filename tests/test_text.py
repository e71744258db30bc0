from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import packing
from corpusmill.functions import text as X
from corpusmill.functions.paths import clean_path, site_of


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "name, tokens, role, signature",
    [("CDC- LRDT Sol_", ["cdc", "lrdt", "sol"], "answer", "cdc lrdt"), ("Question paper with solutions", ["question", "paper", "with", "solutions"], "answer", "with"), ("QA", ["qa"], "unmarked", "qa"), ("a a Q", ["a", "a", "q"], "question", "a a"), ("", [], "unmarked", "")],
)
def test_names(spark, name, tokens, role, signature):
    assert one(spark, X.tokens, name) == tokens
    assert one(spark, X.role, name) == role
    assert one(spark, X.signature, name) == signature


def test_loose_signature(spark):
    assert one(spark, X.loose_signature, "NMAT 1") == one(spark, X.loose_signature, "NMAT1") == "nmat1"


@pytest.mark.parametrize("text, verdict", [(None, "EMPTY"), ("x" * 39, "EMPTY"), ("x" * 40, "CLEAN"), ("  " + "x" * 39 + "  ", "EMPTY"), ("�" * 5 + "x" * 45, "GARBLED"), ("- " * 40 + "x", "GARBLED"), ("​" * 10 + "x" * 40, "GARBLED")])
def test_quality(spark, text, verdict):
    assert one(spark, X.quality, text) == verdict


def test_lines_and_strip_follow_unicode(spark):
    text = "a\r\n b \x0bc d \n\n \ne"
    assert one(spark, X.lines, text) == [x.strip() for x in text.splitlines() if x.strip()]


def test_grounding(spark):
    df = spark.createDataFrame([("Alligation rule with ratio", "the alligation ratio"), ("with", "with"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(F.round(X.grounding(F.col("a"), F.col("b")), 4)).collect()] == [0.6667, 0.0, 0.0]


def test_labels_sizes_and_paths(spark):
    df = spark.createDataFrame([(3, 3), (3, 5)], "a int, b int")
    assert [r[0] for r in df.select(X.page_label(F.col("a"), F.col("b"))).collect()] == ["p3", "p3-5"]
    sizes = spark.createDataFrame([(0,), (1536,), (5 * 1024**3,), (3 * 1024**5,)], "n long")
    assert [r[0] for r in sizes.select(X.human_size(F.col("n"))).collect()] == ["0.0 B", "1.5 KB", "5.0 GB", "3.0 PB"]
    for written, clean in [("./A/b.pdf", "A/b.pdf"), ("A\\b\\c.pdf", "A/b/c.pdf"), ("/A//b.pdf", "A/b.pdf"), (None, None)]:
        assert one(spark, clean_path, written) == clean
    assert one(spark, site_of, ".\\A\\b.pdf") == "A"
    assert [one(spark, X.suffix, p) for p in ("a/b.PDF", "a.b/c", ".hidden", "x.tar.gz")] == [".pdf", "(no extension)", "(no extension)", ".gz"]
    assert [one(spark, X.stem, p) for p in ("a/b.PDF", ".hidden", "x.tar.gz")] == ["b", ".hidden", "x.tar"]


def test_packing_examples():
    assert packing.hard_split("aa bb ccccccc d", 5) == ["aa bb", "ccccc", "cc", "d"]
    assert packing.split_text("ab\n\ncd\n\ne", 5) == ["ab\ncd", "e"]
    assert packing.pack_table(["h", "aaaa", "bbbb", "c"], 10) == ["h\naaaa", "h\nbbbb\nc"]
    assert packing.pack_table(["h", "a" * 20], 10) == ["h\n" + "a" * 20]
    assert packing.pack_table([], 10) == [] and packing.split_text("") == []


@pytest.mark.parametrize("size", [1, 1599, 1600, 1601, 3300])
def test_packing_cap(size):
    out = packing.split_text("y" * size + "\n\nz")
    assert all(len(p) <= 1600 for p in out) and "".join(out).replace("\n", "") == "y" * size + "z"
    assert out == (["y" * size + "\nz"] if size + 2 <= 1600 else [*packing.hard_split("y" * size), "z"])  # an oversize part is not merged
