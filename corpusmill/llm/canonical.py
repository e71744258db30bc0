"""Problem 3: text that looks the same comes out in one form.

The words of the corpus form tries, one for each range of words that begin and end alike and are about as long. A word with
suspect characters walks through the trie of its range with a weighted edit automaton: look-alike characters, ligatures and
ignorable characters cost nothing, everything else costs 1, and only walks within the budget (0) reach a spelling. Of the
spellings reached the canonical one is taken: a spelling without suspect characters first, else the most frequent, else
the smallest. Words that reach none, and everything between words, are normalised by the look-alike table.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookalike import INVISIBLE, TABLE, fold, suspect
from .shared import cut, looked_up, slices

#: Printed characters at either end of a word that, with its length, tell its range, and words of a range.
ENDS, RANGE_WORDS = 2, 10_000
_LETTER = r"(?:[^\W_]|[\u0300-\u036f\u0900-\u0903\u093c-\u094d\u0951-\u0957\u0962\u0963" + INVISIBLE + r"])"
_WORD = re.compile(_LETTER + "+")
_ONE_SCRIPT = re.compile("[Ѐ-ԯ0-9]+|[Ͱ-Ͽ0-9]+")


class Trie:
    """Spellings by their characters. A node is [word and count or None, {first printed character: [(what a character
    prints as, node below)]}, {character: node below}]; characters that print as nothing stand under '' in the first."""

    def __init__(self) -> None:
        self.root: list = [None, {}, {}]

    def add(self, word: str, count: int) -> None:
        node = self.root
        for c in word:
            below = node[2].get(c)
            if below is None:
                below = node[2][c] = [None, {}, {}]
                brings = _BRINGS[c]
                node[1].setdefault(brings[:1], []).append((brings, below))
            node = below
        node[0] = (word, (node[0][1] if node[0] else 0) + count)

    def reach(self, word: str, budget: int = 0) -> list[tuple[int, str, int]]:
        """(cost, spelling, count) of every spelling within the budget.

        A state is (cost, node, place in the word); look-alikes, ligatures and ignorable characters move it on at no
        cost, a character that is missing, added or another one costs 1.
        """
        text = printed(word)
        best: dict[tuple[int, int], int] = {}
        found: dict[str, tuple[int, int]] = {}
        todo = [(0, self.root, 0)]
        while todo:
            cost, node, i = todo.pop()
            if best.get((id(node), i), budget + 1) <= cost:
                continue
            best[id(node), i] = cost
            if i == len(text) and node[0]:
                spelling, count = node[0]
                found[spelling] = min(found.get(spelling, (cost, count)), (cost, count))
            for _, below in node[1].get("", ()):
                todo.append((cost, below, i))
            for brings, below in node[1].get(text[i], ()) if i < len(text) else ():
                if text.startswith(brings, i):
                    todo.append((cost, below, i + len(brings)))
            if cost < budget:
                if i < len(text):
                    todo.append((cost + 1, node, i + 1))
                for below in node[2].values():
                    todo += [(cost + 1, below, i), (cost + 1, below, min(len(text), i + 1))]
        return [(cost, w, n) for w, (cost, n) in found.items()]


class _Brings(dict):
    """What a character of a spelling prints as, accents split off: '' for ignorable ones."""

    def __missing__(self, c: str) -> str:
        self[c] = printed(c)
        return self[c]


def printed(word: str) -> str:
    """The characters a word prints as, accents split off."""
    return word if word.isascii() else unicodedata.normalize("NFD", word.translate(TABLE))


_BRINGS = _Brings()


def range_key(word: str) -> str:
    """How a word begins and ends in print, and its length: coarser than looking alike; the automaton decides the rest."""
    p = printed(word)
    return f"{p[:ENDS]}{p[-ENDS:]}{len(p)}"


def _standing(word: str) -> int:
    """0: nothing suspect; 1: letters of one other script; 2: mixed scripts, ignorable characters or wide forms."""
    if not suspect(word):
        return 0
    return 1 if _ONE_SCRIPT.fullmatch(word) else 2


def canonical_of(reached: list[tuple[int, str, int]], word: str) -> str:
    """The spelling chosen among those reached; the table's form where there is none that stands by itself."""
    standing = [(cost, rank, -n, w) for cost, w, n in reached if (rank := _standing(w)) < 2]
    return min(standing)[3] if standing else fold(word)


def _suspect_words(texts: Iterator[str | None]) -> Counter:
    words: Counter = Counter()
    for t in texts:
        if t:
            words.update(w for w in _WORD.findall(t) if suspect(w))
    return words


def is_suspect(text: Column, heading: Column) -> Column:
    """Rows in which a text or heading has a character that may look like another (one search for each, in C)."""

    @F.pandas_udf("boolean")
    def test(texts: pd.Series, headings: pd.Series) -> pd.Series:
        return pd.Series([(t is not None and suspect(t)) or (h is not None and suspect(h)) for t, h in zip(texts, headings)])

    return test(text, heading)


def vocabulary(df: DataFrame, *texts: str) -> DataFrame:
    """(word, range, suspect, count) of every word, counted inside the tasks before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw: Counter = Counter()

        def flush() -> pd.DataFrame:
            words: Counter = Counter()
            for token, n in raw.items():
                for w in _WORD.findall(token):
                    words[w] += n
            raw.clear()
            kept = [(w, range_key(w), suspect(w), n) for w, n in words.items() if not w.isdigit()]
            return pd.DataFrame(kept, columns=["word", "range", "suspect", "count"])

        for batch in (part for whole in batches for c in whole.columns for part in slices(whole[[c]], c)):
            for t in batch.iloc[:, 0]:
                if t:
                    raw.update(t.split())
            if len(raw) > 200_000:
                yield flush()
        yield flush()

    seen = df.select(*texts).mapInPandas(count, "word string, range string, suspect boolean, count long")
    return seen.groupBy("word", "range", "suspect").agg(F.sum("count").alias("count"))


def spellings(df: DataFrame, *texts: str) -> DataFrame:
    """(word, canonical) of every word with suspect characters, with its canonical spelling.

    Ranges without a suspect word are left out. The others are dealt, in order, over as many tries as RANGE_WORDS asks
    for, so the tries grow in number with the vocabulary, not in size, and a range is never parted.
    """
    words = cut(vocabulary(df, *texts), "words")
    asked = words.where("suspect").select("range").distinct()
    near = cut(words.join(asked, "range", "left_semi"), "near")
    tries = max(1, -(-near.count() // RANGE_WORDS))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, asked = Trie(), []
        for rows in batches:
            for w, odd, n in zip(rows["word"], rows["suspect"], rows["count"]):
                trie.add(w, int(n))
                if odd:
                    asked.append(w)
        for at in range(0, len(asked), 10_000):
            part = asked[at : at + 10_000]
            yield pd.DataFrame({"word": part, "canonical": [canonical_of(trie.reach(w), w) for w in part]})

    return near.repartitionByRange(tries, "range").select("word", "suspect", "count").mapInPandas(walk, "word string, canonical string")


def rewrite(text: str | None, canonical: dict[str, str]) -> str | None:
    """A text with its suspect words in canonical spelling and everything else normalised by the table."""
    if text is None or not suspect(text):
        return text
    out, last = [], 0
    for m in _WORD.finditer(text):
        if suspect(m[0]):
            out += [fold(text[last : m.start()]), canonical.get(m[0]) or fold(m[0])]
        else:
            out += [fold(text[last : m.start()]), m[0]]
        last = m.end()
    return "".join([*out, fold(text[last:])])


def canonical_texts(df: DataFrame, key: str = "chunk_seq", text: str = "text", heading: str = "heading") -> DataFrame:
    """(key, heading, text, changed): every row with text and heading in one consistent form.

    Null stays null, empty stays empty; repeated rows stay repeated; other columns are left behind. Rows without suspect
    characters pass untouched inside the JVM. The spellings are joined by word, not broadcast, as their number grows
    with the data.
    """
    slim = df.select(F.col(key).alias("_key"), F.col(heading).alias("_heading"), F.col(text).alias("_text"))
    plain = slim.where(~is_suspect(F.col("_text"), F.col("_heading"))).select(F.col("_key").alias(key), F.col("_heading").alias("heading"), F.col("_text").alias("text"), F.lit(False).alias("changed"))
    done = _rewritten(slim).select(
        F.col("_key").alias(key), F.col("_new.heading").alias("heading"), F.col("_new.text").alias("text"),
        (~F.col("_new.heading").eqNullSafe(F.col("_heading")) | ~F.col("_new.text").eqNullSafe(F.col("_text"))).alias("changed"),
    )
    return plain.unionByName(done)


def _rewritten(slim: DataFrame) -> DataFrame:
    """The rows of (_key, _heading, _text) with suspect characters, and `_new`, their heading and text in one form."""

    @F.pandas_udf("array<string>")
    def words(t: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([sorted(_suspect_words([a, b])) for a, b in zip(t, h)])

    @F.pandas_udf("heading string, text string")
    def rewritten(t: pd.Series, h: pd.Series, pairs: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, p in zip(t, h, pairs):
            known = {x["word"]: x["canonical"] for x in (p if p is not None else [])}
            out.append((rewrite(b, known), rewrite(a, known)))
        return pd.DataFrame(out, columns=["heading", "text"])

    # equal rows share their spellings; the few suspect rows are kept, as they are read twice
    rows = cut(slim.where(is_suspect(F.col("_text"), F.col("_heading"))).withColumn("_row", F.xxhash64("_text", "_heading")), "suspects")
    used = rows.select("_row", F.explode(words("_text", "_heading")).alias("word")).distinct()
    known = used.join(spellings(slim, "_text", "_heading"), "word").groupBy("_row").agg(F.collect_list(F.struct("word", "canonical")).alias("_pairs"))
    return rows.join(known, "_row", "left").withColumn("_new", rewritten("_text", "_heading", "_pairs"))


def alike_classes(df: DataFrame, key: str = "chunk_seq", text: str = "text", heading: str = "heading") -> DataFrame:
    """(key, class_id, writing_id): every row that looks like a row written in another way.

    Rows of one class look the same in print; rows of one writing are the same in every character. class_id and
    writing_id are the least keys of the class and of the writing. Null counts as the empty text. Empty input gives no
    rows.
    """
    slim = df.select(F.col(key).alias("_key"), F.col(heading).alias("_heading"), F.col(text).alias("_text"))
    raw, form = _both(F.col("_heading"), F.col("_text")), _both(F.col("_new.heading"), F.col("_new.text"))
    new = cut(_rewritten(slim).select(F.col("_key").alias("_id"), F.xxhash64(form).alias("look"), F.sha1(form).alias("print"), F.sha1(raw).alias("writing")), "looks")
    # a class with two writings holds at least one row that was rewritten; a row as it stands joins the class of its text
    odd = new.where("print <> writing").select("look").distinct()
    standing = slim.select(F.col("_key").alias("_id"), F.xxhash64(raw).alias("look"), F.sha1(raw).alias("writing")).join(odd, "look", "left_semi")
    members = new.join(odd, "look", "left_semi").select("_id", "print", "writing")
    members = cut(members.unionByName(standing.select("_id", F.col("writing").alias("print"), "writing")).distinct(), "members")
    writings = members.groupBy("print", "writing").agg(F.min("_id").alias("writing_id"))
    classes = writings.groupBy("print").agg(F.min("writing_id").alias("class_id"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    told = cut(writings.join(classes, "print"), "writings")
    return looked_up(members, told, ["print", "writing"], F.col("_id"), told.count()).select(F.col("_id").alias(key), "class_id", "writing_id")


def alike_pairs(df: DataFrame, key: str = "chunk_seq", text: str = "text", heading: str = "heading") -> DataFrame:
    """(key_a, key_b), a < b: pairs of rows that look the same in print but differ in at least one character, out of the
    classes: writings are paired, not rows, so copies of one writing, however many, never meet each other."""
    rows = cut(alike_classes(df, key, text, heading), "classes")
    writings = rows.select("class_id", "writing_id").distinct()
    pairs = writings.join(writings.select("class_id", F.col("writing_id").alias("other_id")), "class_id").where("writing_id <> other_id")
    a, b = rows.select("writing_id", F.col(key).alias(f"{key}_a")), rows.select(F.col("writing_id").alias("other_id"), F.col(key).alias(f"{key}_b"))
    both = a.join(pairs, "writing_id").join(b, "other_id")
    return both.where(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b").distinct()


def _both(heading: Column, text: Column) -> Column:
    return F.concat(F.coalesce(heading, F.lit("")), F.lit("\u0001"), F.coalesce(text, F.lit("")))
