from __future__ import annotations

import itertools

import pytest

from corpusmill.llm import boilerplate, canonical
from corpusmill.llm.lookalike import fold, suspect

ALIKE = [("office", "oﬃce"), ("a b", "a b"), ("a b", "a b"), ("co-op", "co‑op"), ("Brenlo", "Ｂｒｅｎｌｏ"), ("rule", "r​ule"), ("résumé", "résumé"), ("cope", "соре"), ("KELVIN", "KELVIN"), ("MATE", "ΜΑΤΕ")]
APART = [("x²", "x2"), ("a–b", "a-b"), ("−1", "-1"), ("Rhea", "rhea"), ("Zoë", "Zoe"), ("l5", "15"), ("≤", "<"), ("3", "8"), ("a  b", "a b"), ("×", "x")]


@pytest.mark.parametrize("a, b", ALIKE)
def test_alike(a, b):
    assert fold(a) == fold(b) and fold(fold(b)) == fold(b)


def test_whatever_folding_changes_is_suspect():
    for c in map(chr, range(0x80, 0x30000)):
        if 0xD800 <= ord(c) < 0xE000:
            continue
        assert fold(c) == c or suspect(c), hex(ord(c))
    assert suspect("\u2126") and fold("\u2126") == fold("\u03a9")


@pytest.mark.parametrize("a, b", APART)
def test_apart(a, b):
    assert fold(a) != fold(b)


def test_automaton_costs():
    trie = canonical.Trie()
    for w, n in (("office", 5), ("cope", 3), ("соре", 9), ("сопе", 1)):
        trie.add(w, n)
    assert trie.reach("oﬃce") == [(0, "office", 5)]
    assert sorted(trie.reach("cоpe")) == [(0, "cope", 3), (0, "соре", 9)]
    assert trie.reach("offcie") == [] and trie.reach("offize", 1) == [(1, "office", 5)] and trie.reach("offie", 1) == [(1, "office", 5)]
    assert canonical.canonical_of(trie.reach("cоpe"), "cоpe") == "cope"  # a spelling without suspect characters first


def frame(spark, texts):
    return spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(texts)], "chunk_seq long, heading string, text string").selectExpr("*", "'x' AS word", "'y' AS canonical", "'z' AS look")


def test_pairs_against_brute_force(spark):
    texts = [("H", a) for pair in ALIKE + APART for a in pair] + [(None, "office"), ("", "oﬃce"), ("Ｈ", "office"), ("H", None), ("H", ""), ("H", "​"), ("H", "office"), ("значит", "значит"), ("значит", "знaчит")]
    got = {tuple(r) for r in canonical.alike_pairs(frame(spark, texts)).collect()}
    print_ = lambda x: (fold(x[0] or ""), fold(x[1] or ""))
    raw = lambda x: (x[0] or "", x[1] or "")
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if print_(texts[i]) == print_(texts[j]) and raw(texts[i]) != raw(texts[j])}
    assert got == want
    assert canonical.alike_pairs(frame(spark, texts).where("false")).count() == 0


def test_classes(spark):
    texts = [("H", "office"), ("H", "oﬃce"), ("H", "oﬃce"), ("H", "offlce"), ("H", "office"), (None, "rule"), ("", "rule"), ("", "r\u200bule")]
    got = sorted(map(tuple, canonical.alike_classes(frame(spark, texts)).collect()))
    assert got == [(0, 0, 0), (1, 0, 1), (2, 0, 1), (4, 0, 0), (5, 5, 5), (6, 5, 5), (7, 5, 7)]
    assert canonical.alike_classes(frame(spark, texts).where("false")).count() == 0


def test_automaton_decides_what_is_alike(spark):
    """A range holds words that look otherwise; words of any length come out."""
    rows = [("", "paper proper pacer"), ("", "papеr"), ("", "x" * 300 + "е" + " " + "x" * 300 + "e")]
    got = {r["word"]: r["canonical"] for r in canonical.spellings(frame(spark, rows), "text").collect()}
    assert got == {"papеr": "paper", "x" * 300 + "е": "x" * 300 + "e"}
    assert canonical.range_key("papеr") == canonical.range_key("paper") == canonical.range_key("pamer") != canonical.range_key("pacers")
    trie = canonical.Trie()
    for w in ("paper", "pamer", "pacer"):
        trie.add(w, 1)
    assert trie.reach("papеr") == [(0, "paper", 1)] and trie.reach("pаmer") == [(0, "pamer", 1)] and trie.reach("panеr") == []


def test_canonical_texts(spark):
    rows = [(None, "The rule"), ("The", "Тhе rul​e is"), ("x", "значит да"), ("y", "знaчит"), ("z", None), ("z", "")]
    got = {r["chunk_seq"]: (r["heading"], r["text"], r["changed"]) for r in canonical.canonical_texts(frame(spark, rows)).collect()}
    assert got[0] == (None, "The rule", False) and got[1] == ("The", "The rule is", True)
    assert got[2][1] == "значит да" and got[3][1] in ("значит", fold("значит"))
    assert got[4][1] is None and got[5][1] == ""


def test_wording():
    assert boilerplate.wording("© 2012 Prepnost Pvt. Ltd.") == boilerplate.wording("©  2013 PREPNOST РVT LTD") == "prepnostpvtltd"
    assert boilerplate.wording("12 – 34 %") == "" and boilerplate.wording("यह सामग्री 3") == "यहसामग्री"
    assert boilerplate.wording("Zoë") != boilerplate.wording("Zoe")


def test_repeated_lines_against_brute_force(spark):
    rows, n = [], 0
    for site, files in (("A", 40), ("B", 6), ("C", 3)):
        for f in range(files):
            lines = [f"Unique {chr(97 + f % 26)}{'x' * (f // 26)} words", "All rights reserved 20%02d" % f] if f % 2 == 0 or site != "A" else [f"Other {'y' * (f + 1)}"]
            lines += ["Share  THIS", "with a friend"] if f < 4 else []
            rows.append((n, f"{'./' if f % 3 else ''}{site}{chr(92) if f % 2 else '/'}f{f}.pdf", "\n".join(["1 2 3", *lines])))
            n += 1
    rows += [(n, "A/f0.pdf", "with a friend\n"), (n + 1, None, "with a friend"), (n + 2, "B/f1.pdf", None), (n + 3, "B/f1.pdf", "")]
    df = spark.createDataFrame(rows, "chunk_seq long, source_file string, text string").selectExpr("*", "1 AS site", "2 AS file", "3 AS rank", "4 AS pos")
    found = boilerplate.repeated_blocks(df)
    got = {(r["chunk_seq"], r["line_no"]) for r in found.collect()}
    clean = lambda p: p.replace(chr(92), "/").removeprefix("./")
    files, on = {}, {}
    for _, p, t in rows:
        if p is not None:
            s = clean(p).split("/")[0]
            files.setdefault(s, set()).add(clean(p))
            for x in (t or "").split("\n"):
                on.setdefault((s, boilerplate.wording(x)), set()).add(clean(p))
    want = {(k, i + 1) for k, p, t in rows if p for i, x in enumerate((t or "").split("\n")) if (w := boilerplate.wording(x)) and len(on[(s := clean(p).split("/")[0]), w]) >= max(4, 0.1 * len(files[s]))}
    assert got == want and got
    assert {r["block_lines"] for r in found.collect()} >= {1, 2}
    kept = {r["chunk_seq"]: r["text"] for r in boilerplate.without_repeated(df).collect()}
    assert kept[n] == "" and kept[n + 1] == "with a friend" and kept[n + 2] is None and "Share" not in kept[0]
    assert boilerplate.repeated_blocks(df.where("false")).count() == 0


def test_identifiers_agree(spark):
    lines = ["All rights reserved", "a-b 12", "Zoë", "12", ""]
    df = spark.createDataFrame([(0, "s/f", "\n".join(lines)), (1, "s/f", "all RIGHTS reserved!\nab"), (2, "s/f", None)], "chunk_seq long, source_file string, text string")
    got = {r["_key"]: [(x["line_no"], x["id"]) for x in r["lines"]] for r in boilerplate.lines_of(df).collect()}
    assert got[0] == [(i + 1, boilerplate.identifier(x)) for i, x in enumerate(lines) if boilerplate.identifier(x) is not None] and got[2] == []
    assert [x for _, x in got[1]] == [x for _, x in got[0][:2]]  # the JVM's identifiers are Python's


def longest_prefixes(files, needed):
    """Brute force: for each (file, place) the longest run of lines that `needed` files have, and how many have it."""
    out = {}
    for f, lines in files.items():
        for i in range(len(lines)):
            best = (0, 0)
            for n in range(1, len(lines) - i + 1):
                block = lines[i : i + n]
                on = sum(any(other[k : k + n] == block for k in range(len(other))) for other in files.values())
                if on < needed:
                    break
                best = (n, on)
            out[f, i] = best
    return out


def test_blocks_of_any_length_across_chunks(spark):
    five, three = ["alpha", "beta", "gamma", "delta", "epsilon"], ["one", "two", "three"]
    files, rows = {}, []
    for f in range(12):
        own = [f"own {chr(97 + f)}"]
        lines = own + (five if f % 2 == 0 else []) + [f"mid {chr(97 + f)}"] + (three if f < 5 else []) + (["three"] if f == 11 else [])
        files[f] = [x.replace(" ", "") for x in lines]
        cut = 1 + f % 4  # the block of five crosses the end of a chunk
        rows += [(10 * f, f"S/f{f}.pdf", "\n".join(lines[:cut])), (10 * f + 1, f"S/f{f}.pdf", "7\n" + "\n".join(lines[cut:]))]
    df = spark.createDataFrame(rows, "chunk_seq long, source_file string, text string")
    lines, sizes = boilerplate.sequences(df)
    prefixes, _ = boilerplate.common_prefixes(lines, sizes.selectExpr("site", "4 AS needed"))
    names = {r["file"]: r["name"] for r in df.selectExpr("xxhash64(source_file) AS file", "CAST(regexp_extract(source_file, 'f([0-9]+)', 1) AS int) AS name").distinct().collect()}
    got = {(names[r["file"]], r["pos"]): (r["length"], r["block_files"]) for r in prefixes.collect()}
    assert got == {k: v for k, v in longest_prefixes(files, 4).items() if v[0]}
    found = boilerplate.repeated_blocks(df).collect()
    assert {(r["block_lines"], r["block_files"]) for r in found} == {(5, 6), (3, 5), (1, 6)}
    assert {r["chunk_seq"] for r in found if r["block_lines"] == 5} == {10 * f + i for f in range(0, 12, 2) for i in (0, 1) if not (i == 0 and f % 4 == 0)}
