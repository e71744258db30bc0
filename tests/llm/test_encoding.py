from __future__ import annotations

import pytest

from corpusmill.llm import encoding

WORDS = "Søla Zoë Lomé Marú Jürn São “tradition” Élian prix élève réponse 5° x² √7 ₹300 ≤ − × процентов ученики только когда большой день में और संख्या".split()
CHAINS = [("cp1252",), ("latin-1",), ("mac_roman",), ("cp437",), ("latin-1", "latin-1"), ("gbk",)]


def wrong(text: str, chain: tuple[str, ...]) -> str:
    for codec in chain:
        text = text.encode("utf-8").decode(codec, "replace")
    return text


@pytest.mark.parametrize("chain", CHAINS)
def test_readings_undo_a_chain(chain):
    for w in ("Søla", "Lomé’s", "√75", "₹300"):
        bad = wrong(w, chain)
        if encoding.LOST not in bad and bad != w:
            assert w in {r for _, r, _ in encoding.readings(bad)}, bad


def test_right_words_stay(spark):
    for w in ("NÃO", "ATENÇÃO:", "Naïve", "में"):
        assert not any(g > 0 for _, _, g in encoding.readings(w))
    assert encoding.with_digits("₹000", "₹472") == "₹472" and encoding.with_digits("₹00", "₹472") is None


def pages(spark, garbled):
    rows = []
    for i in range(60):
        line = " ".join(WORDS[(i * 7 + k) % len(WORDS)] for k in range(12))
        rows.append((i, f"f{i % 12}", line))
    return spark.createDataFrame(rows + garbled, "page_id long, source_rel string, text string").selectExpr("*", "1 AS word", "2 AS reading", "3 AS n")


def test_pages_are_named_and_repaired(spark):
    text = "A word of Søla and Lomé costs ₹300 at √7"
    bad = [(100 + i, f"g{i}", wrong(text, c)) for i, c in enumerate(CHAINS[:4])]
    bad += [(110, "g1", "S&#195;&#184;la"), (111, "g2", "S�la sold"), (112, "g3", None), (113, "g3", ""), (114, None, "plain (cid:12) &amp; text"), (115, None, "SÃ¸la"), (110, "g1", "S&#195;&#184;la")]
    df = pages(spark, bad)
    got = {r["page_id"]: r for r in encoding.repaired(df).collect()}
    assert all(got[100 + i]["text"] == text for i in range(4))
    assert got[110]["text"] == "Søla" and got[111]["text"] == "Søla sold" and got[115]["text"] == "Søla"
    assert got[112]["text"] is None and got[113]["text"] == "" and got[114]["places"] == 0
    named = {r[0] for r in encoding.garbled(df).collect()}
    assert named == {100, 101, 102, 103, 110, 111, 115}


def test_no_pages(spark):
    assert encoding.garbled(pages(spark, []).where("false")).count() == 0


def test_a_null_source_is_a_source(spark):
    text = "A word of Søla and Lomé costs ₹300 at √7"
    for name in (None, "named"):
        df = pages(spark, [(200 + i, name, wrong(text, ("mac_roman",))) for i in range(3)])
        told = encoding.decide(df).where(encoding.source_key(encoding.F.lit(name)) == encoding.F.col("source"))
        assert {r["chain"] for r in told.collect()} == {"mac_roman"}
        assert {r["text"] for r in encoding.repaired(df).where("page_id >= 200").collect()} == {text}


def test_any_number_of_wrong_decodings():
    bad = wrong("₹", ("latin-1",) * 5)
    assert "₹" in {r for _, r, _ in encoding.readings(bad)}
