from __future__ import annotations

import pytest

from corpusmill.llm import scans


@pytest.mark.parametrize("wrong, right", [("sy1logisms", "syllogisms"), ("lcisure", "leisure"), ("pyrarnid", "pyramid"), ("Siivarna", "suvarna"), ("passecl", "passed"), ("Pubhcations", "publications"), ("Kellertovvn", "kellertown"), ("againsf", "against"), ("bours", "hours"), ("Fjord@l", "fjordal"), ("5econds", "seconds")])
def test_shapes(wrong, right):
    assert scans.shape(wrong) == scans.shape(right)


@pytest.mark.parametrize("label, value", [("132", 132), ("l8", 18), ("lO0", 100), ("lviii", 58), ("xiv", 14), ("llO", 110), ("ll", 11), ("abc", None), ("", None)])
def test_numbers(label, value):
    assert scans.number(label) == value


FILLER = ["the probability that seconds pass before hours is small and the three-digit rule works", "a reservoir holds leisure and the perimeter of a pyramid which measures twice the hours"]


def build(spark):
    rows = []
    for i in range(30):
        rows.append((i, f"clean{i}", 1, "pymupdf", "\n".join(FILLER)))
    for p in range(1, 6):
        head = "Number System for Aspirants" if p != 3 else "Number Systern for Aspirants"
        body = ["the probability that seconds pass", "before hours is small.", "77", "a reservoir holds leisure."]
        if p == 1:
            body = ["the probability that se-", "conds pass before the three-", "digit hours."]
        if p == 2:
            body = ["the pyrarnid measures twice", "and l5 hours pass."]
        rows.append((100 + p, "scan", p, "ocr" if p % 2 else None, "\n".join([head, "", *body, f"— {40 + p} —"])))
    rows += [(105, "scan", 5, "ocr", rows[-1][4]), (200, "scan", 6, None, None), (201, "scan", 7, "ocr", ""), (202, None, None, None, "one two"), (203, "tables", 1, "pymupdf", "a reservoir holds\n12\n99")]
    return spark.createDataFrame(rows, "page_id long, source_rel string, page_num int, method string, text string").selectExpr("*", "1 AS word", "2 AS kind", "3 AS file", "4 AS line")


def test_noise(spark):
    got = {(r["page_id"], r["kind"]) for r in scans.noise(build(spark)).collect()}
    want = {(100 + p, k) for p in range(1, 6) for k in ("running_line", "page_number")} | {(101, "split_word"), (102, "misread")}
    assert got == want
    assert scans.noise(build(spark).where("false")).count() == 0


def test_readable(spark):
    got = {r["page_id"]: r["text"] for r in scans.readable(build(spark)).collect()}
    assert got[101] == "the probability that seconds pass before the three-digit hours."
    assert got[102] == "the pyramid measures twice and 15 hours pass."
    assert got[0] == "\n".join(FILLER) and got[200] is None and got[201] == ""


def test_lone_number_behind_running_lines(spark):
    def page(p, above, below):
        return (300 + p, "book", p, "ocr", "\n".join(["Journal of Seas", *above, *FILLER, "77", "a pyramid.", *below, "Harbour Press Reprint"]))

    rows = [page(1, ["— 24 —"], []), page(2, [], ["l2"]), page(3, ["more words on the sea", "[84]"], []), page(4, [], ["14"]), page(5, ["99"], [])]
    pages = spark.createDataFrame(rows, "page_id long, source_rel string, page_num int, method string, text string")
    got = {r["page_id"] for r in scans.noise(pages).where("kind = 'page_number'").collect()}
    assert got == {301, 302, 304}
    text = {r["page_id"]: r["text"] for r in scans.readable(pages).collect()}
    assert "24" not in text[301] and "l2" not in text[302] and "14" not in text[304] and "99" in text[305] and "84" in text[303] and "77" in text[302]


def test_null_file(spark):
    rows = [(400 + p, None, p, "ocr", "\n".join(["Journal of Seas", *FILLER, f"{40 + p}"])) for p in range(1, 5)]
    rows += [(410, "", 1, "ocr", "\n".join(["Journal of Seas", *FILLER, "[7]"])), (411, None, 9, "ocr", "A last page without a head.\n— 2 —")]
    pages = spark.createDataFrame(rows, "page_id long, source_rel string, page_num int, method string, text string")
    got = {(r["page_id"], r["kind"]) for r in scans.noise(pages).collect()}
    assert got == {(400 + p, k) for p in range(1, 5) for k in ("running_line", "page_number")} | {(410, "page_number"), (411, "page_number")}


def test_usual_words_only_save_lookups(spark, monkeypatch):
    rows = [(500 + i, f"clean{i}", 1, "pymupdf", f"{FILLER[0]}\nin the 60s and after") for i in range(4)]
    rows += [(510, "scan", 1, "ocr", "in the 60s the l5 hours pass.\nand after")]
    pages = spark.createDataFrame(rows, "page_id long, source_rel string, page_num int, method string, text string")
    for size in (scans.COMMON, 0):
        monkeypatch.setattr(scans, "COMMON", size)
        assert [tuple(r) for r in scans.noise(pages).collect()] == [(510, "misread")]
        text = {r["page_id"]: r["text"] for r in scans.readable(pages).where("page_id = 510").collect()}[510]
        assert "60s" in text and "15 hours" in text
