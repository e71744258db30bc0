from __future__ import annotations

import random

import numpy as np

from corpusmill.llm import leakage

NOUNS = "glacier orchard viaduct weir foundry guild parliament chandler almanac causeway apiary regatta tannery minstrel herbarium locksmith".split()
VERBS = "polished judged mourned rationed borrowed counted sketched divided repaired guarded translated ignored".split()
ADJECTIVES = "velvet restless humble amber brittle jagged wary tidy muted zealous cloistered frosted".split()


def passage(r, n):
    return " ".join(r.choice((NOUNS, VERBS, ADJECTIVES)[i % 3]) for i in range(n))


def brute(words, item):
    """Edit distance of every stretch of at least SPAN words of the item against every place of the document."""
    for a in range(len(item) - leakage.SPAN + 1):
        row = [0] * (len(words) + 1)
        for i, w in enumerate(item[a:], 1):
            new = [i]
            for j in range(1, len(words) + 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (words[j - 1] != w)))
            row = new
            if i >= leakage.SPAN and min(row) <= i // leakage.EDITS:
                return True
    return False


def build(spark):
    r = random.Random(3)
    stock = "Read the passage carefully before you attempt the questions that follow."
    items = [(f"i{k}", f"{stock} {passage(r, 22)}?", passage(r, 40) if k % 2 else None) for k in range(8)]
    items += [("twin", "short one", items[1][2]), ("none", None, None), (None, passage(r, 30), None)]
    docs, n = [], 0
    for k in range(8):
        q = items[k][1].removeprefix(stock).strip("? ").split()
        for change in range(5):
            start = r.randrange(0, 5)
            piece = q[start : start + 16]
            for _ in range(change):
                at, kind = r.randrange(1, len(piece) - 1), r.randrange(3)
                piece[at : at + 1] = [["other"], [], [piece[at], "extra"]][kind]
            docs.append((n, f"{passage(r, 60)} {' '.join(piece).upper().replace(' ', ', ')} {passage(r, 30)}"))
            n += 1
    docs += [(n, stock), (n + 1, None), (n + 2, ""), (n + 3, items[1][2].replace("a", "а")), (n + 4, f"<b>{items[3][2]}</b>"), (n + 3, items[1][2])]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS question"),
        spark.createDataFrame(items, "item_id string, question string, passage string").selectExpr("*", "3 AS text", "4 AS doc_id"),
        docs,
    )


def test_against_brute_force(spark):
    documents, items, docs = build(spark)
    got = {(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(documents, items).collect()}
    texts = leakage.item_texts([r for r in items.where("item_id IS NOT NULL").collect()])
    want = {(d, i) for d, t in docs for i, w in texts if brute(leakage.words_of(t), w)}
    assert got == want
    assert {i for d, i in got if d == docs[-1][0]} >= {"i1", "twin"}


def test_blocks_of_items_and_empty_tables(spark):
    documents, items, _ = build(spark)
    one, many = leakage.leaked_items(documents, items), leakage.leaked_items(documents, items, block_characters=600)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert leakage.leaked_items(documents.where("false"), items).count() == 0
    assert leakage.leaked_items(documents, items.where("false")).count() == 0


def test_words():
    assert leakage.words_of("A **Velvet** <i>vine&shy;yard</i>, tоll gate") == ["a", "velvet", "vineyard", "toll", "gate"]


def test_markup_of_any_length(spark):
    far = "https://example.org/" + "long-way/" * 35
    words = passage(random.Random(5), 24).split()
    tag, image, bare = f'<a href="{far}" class="x > y">', f"<img src='{far}' alt=\"some other words\"/>", f"<{far}>"
    link = f'[{words[11]}\n{words[12]}]({far}_(a) "A title of some more words, and a few")'
    nested = f"[![{words[18]}]({far})]({far} 'Title')"
    text = " ".join([*words[:6], tag, *words[6:11], link, *words[13:15], image, *words[15:18], nested, bare, *words[19:], "</a>"])
    assert leakage.words_of(text) == words
    prose = f"where x <y and {', '.join(words)} or z> w; [1](as {' '.join(words)})"
    assert [w for w in leakage.words_of(prose) if w in words] == words * 2
    for piece in ("<a b=", '<a b="', "[", "](", "](a", '](a "', "](a(b)", "<a ", "![a](b "):
        leakage.words_of(piece * 20_000)  # takes time in proportion
    documents = spark.createDataFrame([(1, text), (2, prose)], "doc_id long, text string")
    items = spark.createDataFrame([("i", None, " ".join(words))], "item_id string, question string, passage string")
    assert {r["doc_id"] for r in leakage.leaked_items(documents, items).collect()} == {1, 2}


def test_stock_openings_count_over_all_blocks(spark):
    r = random.Random(7)
    stock = f"{passage(r, 18)}."
    items = spark.createDataFrame([(f"s{k}", f"{stock} {passage(r, 20)}?", None) for k in range(6)], "item_id string, question string, passage string")
    documents = spark.createDataFrame([(1, f"{passage(r, 20)} {stock} few words"), (2, items.first()["question"])], "doc_id long, text string")
    for size in (leakage.BLOCK_CHARACTERS, 100):
        assert [tuple(x)[:2] for x in leakage.leaked_items(documents, items, block_characters=size).collect()] == [(2, "s0")]


def test_recall_against_all_pairs_that_share_a_shingle(spark, data):
    items = spark.read.parquet(f"{data}/eval_items.parquet").collect()
    index, pairs, found = leakage.Index(leakage.item_texts(items)), set(), set()
    for d, text in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        words = leakage.words_of(text)
        h = leakage._hashes(words, {})
        if len(h):
            held = set(h.tolist())
            pairs |= {(d, t) for t, (own, _) in enumerate(index.shingles) if not held.isdisjoint(own.tolist()) and index.verified(words, h, t)}
            found |= {(d, t) for _, t in index.candidates(h, np.asarray([len(h)])) if index.verified(words, h, t)}
    assert found <= pairs and len(found) >= 0.99 * len(pairs)


def test_sketch_of_fixed_size():
    for size in leakage.SIZES:
        r = leakage.rows_of_a_band(size)
        assert 1 - (1 - leakage.similarity(size) ** r) ** (leakage.PERMUTATIONS // r) >= leakage.RECALL
    r = np.random.default_rng(3)
    sets = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = (leakage.signatures(x, np.asarray([0]), np.asarray([300]), 300) for x in (sets[:300], sets[100:]))
    assert a.shape == (leakage.PERMUTATIONS, 1) and abs((a == b).mean() - 0.5) < 0.12  # agree as often as the sets overlap


def test_candidates_reach_the_recall():
    """Pairs of a long document and a text that share LEAST_SHARED shingles, against brute force."""
    r, found, n = random.Random(9), 0, 0
    for size in leakage.SIZES:
        for k in range(120):
            text = [f"t{k}-{i}" for i in range(size + leakage.SHINGLE - 1)]
            index = leakage.Index([("i", text)])
            at, words = r.randrange(0, size - 1), [f"d{k}-{i}" for i in range(400)]
            place = r.randrange(0, 390)
            words[place : place + 6] = text[at : at + 6]
            h = leakage._hashes(words, {})
            n += 1
            found += index.candidates(h, np.asarray([len(h)])) == [(0, 0)]
    assert found >= 0.97 * n  # RECALL is what is expected at this similarity, the least of any case
