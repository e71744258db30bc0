"""Problem 6: evaluation texts inside documents.

Containment search by MinHash, partitioned by size. Test texts are told apart by their number of five-word shingles: those
up to the first size are one set each, longer ones are covered by overlapping windows of the next size. Documents are
covered, for each size, by overlapping blocks of twice that size, so that a short test text is held against blocks of its own
order whatever the document's length. A case shares at least LEAST_SHARED shingles with a window, so the containment
asked for is LEAST_SHARED / size; as the sizes of both sets are known it is a Jaccard similarity too, and the bands of the
PERMUTATIONS minima are as wide as lets RECALL of the pairs at that similarity agree in a band. Pairs that agree are
verified by the exact shingles they share and an alignment: some stretch of at least SPAN words of the item must stand in
the document, in order, with at most one word in eight changed, dropped or added.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookalike import fold, suspect
from .shared import slices

SHINGLE, SPAN, EDITS = 5, 15, 8
#: Sizes of the partitions in shingles, minima of a set, pairs that must be found, and shingles that any case shares: 16
#: words of which two are changed leave 14 in three runs, at best 5, 5 and 4 (15 words with one changed leave more).
SIZES, PERMUTATIONS, RECALL, LEAST_SHARED = (16, 24), 160, 0.99, 2
#: Characters of test texts in one index, and indexes that one pass over the documents probes.
BLOCK_CHARACTERS, AT_ONCE = 2_000_000, 4
SHARED_OPENING = 3

# Tags of any length are told by their attributes (prose between < and > is none), short ones and addresses by the brackets.
_ATTRIBUTE = r"""\s++[A-Za-z_:@][\w.:@-]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?+"""
_ADDRESS = r"""(?:\(\s*+(?:<[^<>\n]*+>|[^\s()]*+(?:\([^\s()]*+\)[^\s()]*+)*+)(?:\s++(?:"[^"]*+"|'[^']*+'|\([^()]*+\)))?+\s*+\)|\([^)\s]{0,200}\))"""
_TAG = re.compile(
    rf"<(?=[^<>=]*+=|[^\s<>]*+\s++[^\s<>]*+>)[A-Za-z][\w:.-]*+(?:{_ATTRIBUTE})*+\s*+/?>|</?[A-Za-z](?:[^<>]{{0,80}}|[^\s<>]*+)>"
    rf"|&(?:[A-Za-z]{{2,8}}|#\d{{1,6}}|#x[0-9a-fA-F]{{1,5}});|!?\[([^\[\]]*+)\]{_ADDRESS}|\]{_ADDRESS}"
)
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-\u00ad\u2010\u2011¬]\s*\n\s*(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def _unmark(m: re.Match) -> str:
    if m[0][0] == "&":
        return html.unescape(m[0])
    return m[1] if m[1] is not None else " " if m[0][0] == "<" else ""


def words_of(text: str | None) -> list[str]:
    """Words without letter case, punctuation, markup, line-end hyphens and look-alike characters."""
    if not text:
        return []
    if "<" in text or "&" in text or "](" in text:
        text = _TAG.sub(_unmark, text)
    if suspect(text):
        text = fold(text)
    return _WORD.findall(text.lower())


def _hashes(words: list[str], cache: dict[str, int]) -> np.ndarray:
    """Hashes of the five-word shingles of a word list."""
    if len(words) < SHINGLE:
        return np.empty(0, np.uint64)
    ids = np.fromiter((cache.get(w) or cache.setdefault(w, xxhash.xxh64_intdigest(w) | 1) for w in words), np.uint64, len(words))
    return _roll(ids)


def _roll(ids: np.ndarray) -> np.ndarray:
    n = len(ids) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[k : k + n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(11)
    return r.integers(1, 1 << 32, PERMUTATIONS, dtype=np.uint32), r.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


_FLIP, _TIMES = _permutations()


def signatures(shingles: np.ndarray, starts: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """(PERMUTATIONS, sets): the least value of each permutation in every set of `counts` (1 to `size`) shingles."""
    # sets side by side, filled up with their last shingle
    x = (shingles >> np.uint64(32)).astype(np.uint32)[starts + np.minimum(np.arange(size)[:, None], counts - 1)]
    out, held = np.empty((PERMUTATIONS, len(starts)), np.uint32), np.empty_like(x)
    for j in range(PERMUTATIONS):
        np.bitwise_xor(x, _FLIP[j], out=held)
        np.multiply(held, _TIMES[j], out=held)
        held.min(0, out=out[j])
    return out


def similarity(size: int) -> float:
    """Jaccard similarity of a window of `size` shingles and a block of twice as many that share LEAST_SHARED."""
    return LEAST_SHARED / (3 * size - LEAST_SHARED)


def rows_of_a_band(size: int) -> int:
    """The most rows with which RECALL of the pairs at a size's similarity agree in some band; at least 1."""
    return max([1, *(r for r in range(1, 9) if 1 - (1 - similarity(size) ** r) ** (PERMUTATIONS // r) >= RECALL)])


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """(bands, sets): one value for the minima of each band."""
    value = signature[0::rows][: PERMUTATIONS // rows].copy()
    for k in range(1, rows):
        value = value * np.uint32(0x9E3779B1) ^ signature[k::rows][: PERMUTATIONS // rows]
    return value


def _opening(question: str | None) -> tuple[str | None, str | None]:
    """The words of a question's first sentence, by spaces, and what follows it."""
    parts = re.split(r"(?<=[.!?:])\s+", (question or "").strip(), maxsplit=1)
    return (" ".join(words_of(parts[0])) or None, parts[1]) if len(parts) == 2 else (None, None)


def stock_openings(items: DataFrame, least: int = SHARED_OPENING) -> set[tuple[str, ...]]:
    """First sentences with which at least `least` different questions open, over all items: stock instructions."""

    @F.pandas_udf("struct<opening:string,rest:string>")
    def opening(questions: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_opening(q) for q in questions], columns=["opening", "rest"], dtype=object)

    every = items.select(opening("question").alias("o")).select("o.*").where("opening IS NOT NULL")
    shared = every.groupBy("opening").agg(F.countDistinct("rest").alias("n")).where(F.col("n") >= least)
    return {tuple(r["opening"].split(" ")) for r in shared.select("opening").collect()}


def item_texts(items: list, stock: set[tuple[str, ...]] | None = None) -> list[tuple[str, list[str]]]:
    """(item_id, words) of each question, without its stock instruction, and each passage.

    `stock` are the openings shared over all items; without it the given items are all there are.
    """
    if stock is None:
        rests: dict[str, set[str]] = defaultdict(set)
        for o, rest in (_opening(r["question"]) for r in items):
            if o:
                rests[o].add(rest)
        stock = {tuple(o.split(" ")) for o, v in rests.items() if len(v) >= SHARED_OPENING}
    lengths = sorted({len(s) for s in stock}, reverse=True)
    out = []
    for r in items:
        q = words_of(r["question"])
        n = next((n for n in lengths if tuple(q[:n]) in stock), 0)  # the longest
        out += [(r["item_id"], w) for w in (q[n:], words_of(r["passage"])) if len(w) >= SPAN]
    return out


class Index:
    """Bands of the windows of one block of test texts, for each size, and the texts' exact shingles."""

    def __init__(self, texts: list[tuple[str, list[str]]]) -> None:
        by_words: dict[tuple[str, ...], set[str]] = defaultdict(set)
        for item, w in texts:
            by_words[tuple(w)].add(item)
        self.texts = [(list(w), sorted(items)) for w, items in by_words.items()]
        cache: dict[str, int] = {}
        self.shingles = []
        parts: dict[int, list[tuple[np.ndarray, int]]] = {size: [] for size in SIZES}
        for t, (w, _) in enumerate(self.texts):
            h = _hashes(w, cache)
            order = np.argsort(h, kind="stable")
            self.shingles.append((h[order], order))
            size = next((s for s in SIZES if len(h) <= s), SIZES[-1])
            for start in {*range(0, max(1, len(h) - size + 1), size // 2), max(0, len(h) - size)}:
                parts[size].append((h[start : start + size], t))
        self.bands = {}
        for size, sets in parts.items():
            if sets:
                counts = np.asarray([len(x) for x, _ in sets])
                values = bands(signatures(np.concatenate([x for x, _ in sets]), np.cumsum(counts) - counts, counts, size), rows_of_a_band(size))
                order, owner = np.argsort(values, axis=1), np.asarray([t for _, t in sets])
                known = np.zeros((len(values), 1 << 16), bool)
                known[np.arange(len(values))[:, None], values >> np.uint32(16)] = True
                self.bands[size] = (np.take_along_axis(values, order, 1), owner[order], known)

    def candidates(self, shingles: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
        """(document, text) pairs of which a block and a window agree in a band; counts are the documents' shingles."""
        found: set[tuple[int, int]] = set()
        for size, blocks in document_blocks(shingles, counts, tuple(self.bands)).items():
            doc, values = blocks
            for band, (mine, (sorted_, owner, known)) in enumerate(zip(values, zip(*self.bands[size]))):
                maybe = np.flatnonzero(known[mine >> np.uint32(16)])
                i, j = np.searchsorted(sorted_, mine[maybe], "left"), np.searchsorted(sorted_, mine[maybe], "right")
                for k in np.flatnonzero(j > i):
                    found.update((int(doc[maybe[k]]), int(t)) for t in owner[i[k] : j[k]])
        return sorted(found)

    def verified(self, words: list[str], shingles: np.ndarray, text: int) -> int:
        """Exact shingles that a document shares with a text, where at least SPAN consecutive words of the text stand in
        it with at most one in EDITS changed; 0 otherwise."""
        values, places = self.shingles[text]
        i, j = np.searchsorted(values, shingles, "left"), np.searchsorted(values, shingles, "right")
        hits = np.flatnonzero(j > i)
        seeds = [(int(at), int(p)) for at in hits for p in places[i[at] : j[at]]]
        return len(hits) if _aligned(words, self.texts[text][0], seeds) else 0


def document_blocks(shingles: np.ndarray, counts: np.ndarray, sizes: tuple[int, ...]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each size (document, bands) of the blocks of twice the size that start every `size` shingles."""
    out, begin = {}, np.cumsum(counts) - counts
    for size in sizes:
        halves = -(-counts // size)
        doc = np.repeat(np.arange(len(counts)), halves)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(halves) - halves, halves)
        least = signatures(shingles, begin[doc] + step * size, np.minimum(counts[doc] - step * size, size), size)
        pair = np.flatnonzero(np.r_[doc[1:] == doc[:-1], False])
        least[:, pair] = np.minimum(least[:, pair], least[:, pair + 1])
        keep = np.ones(len(doc), bool)
        keep[pair + 1] = False  # the last half stands in the block before it
        keep[pair] = True
        out[size] = (doc[keep], bands(least[:, keep], rows_of_a_band(size)))
    return out


def _aligned(words: list[str], item: list[str], seeds: list[tuple[int, int]]) -> bool:
    """Grow each run of equal words on both sides; a change, a drop and an addition cost one each.

    No stretch needs to be looked at beyond 3 * SPAN words of the item on either side: of a stretch of 2 * SPAN words or
    more with at most one edit in EDITS, cut in two, one part has no more than that and is long enough.
    """
    runs, seen = [], set()
    for i, p in sorted(seeds, key=lambda s: (s[0] - s[1], s[0])):
        if (i, p) in seen:
            continue
        a, b = i, p
        while a > 0 and b > 0 and words[a - 1] == item[b - 1]:
            a, b = a - 1, b - 1
        c, e = i, p
        while c < len(words) and e < len(item) and words[c] == item[e]:
            seen.add((c, e))
            c, e = c + 1, e + 1
        runs.append((a, b, c, e))
    for a, b, c, e in runs:
        if e - b >= SPAN:
            return True
        left = _grow(words[max(0, a - 4 * SPAN) : a][::-1], item[max(0, b - 3 * SPAN) : b][::-1])
        right = _grow(words[c : c + 4 * SPAN], item[e : e + 3 * SPAN])
        for kl, (nl, _) in enumerate(left):
            for kr, (nr, _) in enumerate(right):
                n = nl + nr + e - b
                if n >= SPAN and (kl + kr) * EDITS <= n:
                    return True
    return False


def _grow(words: list[str], item: list[str]) -> list[tuple[int, int]]:
    """For each number of edits k, the most item words that can be matched so from the start (item words, words)."""
    most = len(item) // EDITS + 3
    reach = {0: 0}  # offset words - item: item words reached
    out = []
    for k in range(most + 1):
        if k:
            new: dict[int, int] = {}
            for d, n in reach.items():
                for dd, nn in ((d, n + 1), (d - 1, n + 1), (d + 1, n)):
                    if nn <= len(item) and 0 <= nn + dd <= len(words) and new.get(dd, -1) < nn:
                        new[dd] = nn
            reach = new
        for d in list(reach):
            n = reach[d]
            while n < len(item) and n + d < len(words) and words[n + d] == item[n]:
                n += 1
            reach[d] = n
        if not reach:
            break
        best = max(reach.items(), key=lambda x: x[1])
        out.append((best[1], best[1] + best[0]))
        if best[1] == len(item):
            break
    return out or [(0, 0)]


def leaked_items(documents: DataFrame, items: DataFrame, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """(doc_id, item_id, shared_shingles) of every document that holds a passage or question of a test item.

    The test items are a stated query set: they are dealt into blocks of about block_characters characters, and AT_ONCE
    blocks go over all documents in one pass, so what is sent to a task is bounded whatever their number; stock openings
    are counted over all items, and the driver holds those. Null texts, passages and ids of items hold nothing; texts
    shorter than SPAN words cannot be a case; repeated documents each get their rows. A passage shared by several items
    names them all. Neither side's other columns are read.
    """
    spark = documents.sparkSession
    listed = items.select("item_id", "question", "passage").where("item_id IS NOT NULL").distinct()
    size = F.length(F.concat_ws(" ", "question", "passage"))
    n, characters = listed.agg(F.count("*"), F.sum(size)).first()
    parts = max(1, min(n, -(-(characters or 0) // block_characters)))
    rows = listed.withColumn("_part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    kind = documents.schema["doc_id"].dataType.simpleString()
    stock = stock_openings(listed)
    passes = []
    for first in range(0, parts, AT_ONCE):
        some = [rows.where(F.col("_part") == part).collect() for part in range(first, min(parts, first + AT_ONCE))]
        indexes = [spark.sparkContext.broadcast(Index(item_texts(x, stock))) for x in some]
        passes.append(documents.select("doc_id", "text").mapInPandas(_search(indexes), f"doc_id {kind}, item_id string, shared_shingles int"))
    return reduce(DataFrame.unionByName, passes).groupBy("doc_id", "item_id").agg(F.max("shared_shingles").alias("shared_shingles"))


def _search(indexes: list):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for batch in (part for whole in batches for part in slices(whole, "text")):  # bounded lists of words
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            plain = [words_of(t) for t in texts]
            joined = [words_of(_HYPHEN.sub("", t)) if t and "\n" in t and _HYPHEN.search(t) else None for t in texts]
            readings = [(i, w) for i, (a, b) in enumerate(zip(plain, joined)) for w in (a, b) if w is not None and len(w) >= SPAN - SPAN // EDITS]
            counts = np.asarray([len(w) - SHINGLE + 1 for _, w in readings], np.int64)
            if not len(counts):
                continue
            if len(cache) > 500_000:
                cache.clear()
            flat = [x for _, w in readings for x in w]
            numbers = np.fromiter((cache.get(w) or cache.setdefault(w, xxhash.xxh64_intdigest(w) | 1) for w in flat), np.uint64, len(flat))
            ends = np.cumsum([len(w) for _, w in readings])
            inside = np.ones(len(flat) - SHINGLE + 1, bool)
            for e in ends[:-1]:
                inside[e - SHINGLE + 1 : e] = False
            shingles = _roll(numbers)[inside]
            begin = np.cumsum(counts) - counts
            hits: dict[tuple, int] = {}
            for look in (index.value for index in indexes):
                for r, t in look.candidates(shingles, counts):
                    i, words = readings[r]
                    if shared := look.verified(words, shingles[begin[r] : begin[r] + counts[r]], t):
                        for item in look.texts[t][1]:
                            hits[i, item] = max(hits.get((i, item), 0), shared)
            if hits:
                yield pd.DataFrame([(ids[i], item, n) for (i, item), n in hits.items()], columns=["doc_id", "item_id", "shared_shingles"])

    return search
