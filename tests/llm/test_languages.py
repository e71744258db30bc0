from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import languages

WORDS = {
    "en": "the house of this river with many people and their garden which was never closed before evening".split(),
    "de": "das Haus mit einem Garten und nicht weit vom Fluss weil die Leute abends immer zusammen sitzen".split(),
    "ru": "этот дом стоит рядом с рекой и люди часто сидят вместе потому что вечером тихо".split(),
}
CODES = [("en", "English", "eng"), ("de", "German", "deu"), ("ru", "Russian", "rus")]


def sentence(r, lang, n=9):
    return " ".join(r.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    r = np.random.default_rng(4)
    rows = []
    for i in range(240):
        lang = ("en", "de", "ru")[i % 3]
        label = lang if i % 12 else ("en", "de", "ru")[(i + 1) % 3]
        rows.append((i, label, " ".join(sentence(r, lang) for _ in range(6))))
    extra = [
        (1000, "EN-gb", " ".join(sentence(r, "en") for _ in range(3))), (1001, None, sentence(r, "ru") + " " + sentence(r, "ru")), (1002, "German", " ".join(sentence(r, "de") for _ in range(3))),
        (1003, "en", sentence(r, "en") + " " + sentence(r, "en") + "\n" + sentence(r, "ru") + " " + sentence(r, "en")), (1004, None, "1. (a) 2. (b) 3. (c)"), (1005, "de", None), (1006, "xx", ""), (1007, "rus", " ".join(sentence(r, "en") for _ in range(3))),
    ]
    documents = spark.createDataFrame(rows + extra, "doc_id long, lang string, text string").selectExpr("*", "1 AS segments", "2 AS row", "3 AS code")
    codes = spark.createDataFrame(CODES, "lang string, lang_name string, alpha3 string")
    return documents, codes, languages.train(documents, codes, epochs=10), rows


def test_labels(spark):
    codes = {s.lower(): c for c, n, a in CODES for s in (c, n, a)}
    df = spark.createDataFrame([(x,) for x in ("EN", "en_US", "deu", " German ", "xx", "", None, "und", "de-AT")], "l string")
    assert [r[0] for r in df.select(languages.label_code(F.col("l"), codes)).collect()] == ["en", "en", "de", "de", None, None, None, None, "de"]


def test_tables_give_the_convolution(corpus):
    net = corpus[2]
    x = np.random.default_rng(1).integers(0, 256, (5, languages.WINDOW)).astype(np.uint8)
    h = []
    for w in languages.WIDTHS:
        spans = np.stack([net.embed[x[:, i : i + w]].reshape(5, -1) for i in range(x.shape[1] - w + 1)], 1)
        h.append(np.maximum((spans @ net.filters[w] + net.bias[w]).max(1), 0))
    z = np.concatenate(h, 1) @ net.dense + net.offset
    want = z - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)) - z.max(1, keepdims=True)
    assert np.allclose(net.log_probabilities(x, block=2), want, atol=1e-4)


def test_windows_cover_every_byte():
    text = "abc. " + "x" * 250 + ". End"
    buffer, starts, ends, _ = languages.sentences([text])
    x, owner = languages.windows(buffer, starts, ends)
    assert sum(len(set(x[owner == i].tobytes()) - {0}) > 0 for i in range(len(starts))) == len(starts)
    assert [bytes(buffer[s:e]) for s, e in zip(starts, ends)] == [b"abc", b"x" * 250, b"End"]


def test_held_out_accuracy(corpus):
    r, net = np.random.default_rng(9), corpus[2]
    right = 0
    for i in range(300):
        lang = ("en", "de", "ru")[i % 3]
        right += languages._segments(net, [sentence(r, lang)])[0][0]["lang"] == lang
    assert right >= 290


def test_mislabelled(corpus):
    documents, codes, net, rows = corpus
    got = {(r["doc_id"], r["lang"]) for r in languages.mislabelled(documents, codes, net).collect()}
    want = {(i, ("en", "de", "ru")[i % 3]) for i, label, _ in rows if label != ("en", "de", "ru")[i % 3]} | {(1001, "ru"), (1003, "en"), (1003, "ru"), (1007, "en")}
    assert len(got ^ want) <= 4 and {x for x in got if x[0] >= 1000} == {x for x in want if x[0] >= 1000}


def test_segments_and_languages(corpus):
    documents, _, net, _ = corpus
    found = languages.segments(documents.where("doc_id >= 1003"), net)
    by = {r["doc_id"]: r["segments"] for r in found.collect()}
    assert [s["lang"] for s in by[1003]] == ["en", "ru", "en"] and by[1004] == [] and by[1005] == [] and by[1006] == []
    assert {r["lang"] for r in languages.languages(found).where("doc_id = 1003").collect()} == {"en", "ru"}


def test_nothing_to_train_on(spark, corpus):
    documents, codes, _, _ = corpus
    assert languages.train(documents.where("false"), codes) is None
    assert languages.mislabelled(documents.where("false"), codes).count() == 0
