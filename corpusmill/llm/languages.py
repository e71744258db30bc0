"""Problem 8: the language of documents and of their segments.

A byte convolutional network, trained in numpy on a bounded sample of labelled documents: byte embeddings, filters of
several widths, max pooling over the window and softmax. It reads fixed-length windows of bytes, laid over every sentence
from its start to its end. A sentence's language is the one with the highest summed log-probability of its windows.

As a convolution over an embedded byte is a sum of one table row for each tap, the trained filters are applied as sums of
rows of byte-pair tables; the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, slices

#: Bytes of a window; filter widths (even, made of byte pairs); filters of each width; sizes of the embedding.
WINDOW, WIDTHS, FILTERS, EMBED = 96, (2, 4, 6), 16, 8
#: Labelled documents the training takes at most of each language, windows at most of each of them, and passes.
SAMPLE, WINDOWS_EACH, EPOCHS = 160, 8, 8
#: Words of a sentence that counts as prose, and the confidence above which it speaks for a second language.
LEAST_WORDS, SURE = 6, 0.95

_SENTENCE = re.compile(rb"[.!?]+[\"')\]]*(?:\xe2\x80[\x9d\x99]|\xc2\xbb)*[ \t]+|\xe0\xa5\xa4[ \t]*|[ \t]*\n\s*")


def label_code(lang: Column, codes: dict[str, str]) -> Column:
    """The code a label names, however it is spelled (case, region, name, three letters); null where it names none."""
    plain = F.lower(F.trim(lang))
    head = F.regexp_extract(plain, r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    known = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]) if codes else F.create_map(F.lit(""), F.lit(""))
    return F.coalesce(F.try_element_at(known, plain), F.try_element_at(known, head))


def code_table(lang_codes: DataFrame, most: int = 1000) -> dict[str, str]:
    """Spelling -> code of a table of languages (settings; at most `most` rows, which is checked)."""
    rows = lang_codes.select("lang", "lang_name", "alpha3").where("lang IS NOT NULL").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} languages")
    return {s.strip().lower(): r["lang"] for r in rows for s in (r["lang_name"], r["alpha3"], r["lang"]) if s}


def windows(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows, their sentence): each sentence's bytes in windows of `size`, filled up with zeros.

    The last window of a longer sentence is moved back so that it is full.
    """
    lengths = ends - starts
    count = np.maximum(1, -(-lengths // size))
    owner = np.repeat(np.arange(len(starts)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[owner] + step * size
    at = np.where((step > 0) & (at + size > ends[owner]), np.maximum(starts[owner], ends[owner] - size), at)
    index = at[:, None] + np.arange(size)
    out = buffer[np.minimum(index, len(buffer) - 1)]
    out[index >= ends[owner][:, None]] = 0
    return out, owner


class ByteNet:
    """Embedding, filters of several widths with ReLU and max pooling, softmax."""

    def __init__(self, classes: list[str], seed: int = 1) -> None:
        r = np.random.default_rng(seed)
        self.classes = classes
        self.embed = r.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.filters = {w: r.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.dense = r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.offset = np.zeros(len(classes), np.float32)
        self._tables: dict | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tables": None}

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, self.dense, self.offset, *self.filters.values(), *self.bias.values()]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, weight: np.ndarray | None = None, rate: float = 0.005, batch: int = 64, seed: int = 2) -> ByteNet:
        """Adam on the cross entropy; `weight` says how many rows of the corpus a row stands for."""
        weight = np.ones(len(x), np.float32) if weight is None else (weight / weight.mean()).astype(np.float32)
        r, step, total = np.random.default_rng(seed), 0, epochs * -(-len(x) // batch)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self._parameters()]
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                step += 1
                for p, g, (m, v) in zip(self._parameters(), self._gradients(x[rows], y[rows], weight[rows]), moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (rate * (1 - step / (total + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
                self.embed[0] = 0
        self._tables = None
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        e = self.embed[x]
        pooled, best, spans = [], [], []
        for w in WIDTHS:
            span = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, -1, w * EMBED)
            z = span @ self.filters[w] + self.bias[w]
            arg = z.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(z, arg[:, None], 1)[:, 0], 0))
            best.append(arg)
            spans.append(span)
        h = np.concatenate(pooled, 1)
        z = h @ self.dense + self.offset
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p *= (weight / n)[:, None]
        dh = (p @ self.dense.T) * (h > 0)
        d_embed, d_filters, d_bias = np.zeros_like(self.embed), [], []
        for k, w in enumerate(WIDTHS):
            g = dh[:, k * FILTERS : (k + 1) * FILTERS]
            chosen = np.take_along_axis(spans[k], best[k][:, :, None], 1)  # (n, FILTERS, w * EMBED)
            d_filters.append(np.einsum("nf,nfd->df", g, chosen))
            d_bias.append(g.sum(0))
            back = g[:, :, None] * self.filters[w].T[None]
            bytes_at = np.take_along_axis(x[:, None, :], best[k][:, :, None] + np.arange(w), 2)
            np.add.at(d_embed, bytes_at.reshape(-1), back.reshape(-1, EMBED))
        return [d_embed, h.T @ p, p.sum(0), *d_filters, *d_bias]

    def tables(self) -> dict:
        """For each width and byte pair of a filter, what the 65,536 pairs add to the filters."""
        if self._tables is None:
            self._tables = {}
            for w in WIDTHS:
                taps = self.filters[w].reshape(w, EMBED, FILTERS)
                rows = [self.embed @ t for t in taps]
                self._tables[w] = [(rows[j][:, None] + rows[j + 1][None]).reshape(65536, FILTERS).astype(np.float32) for j in range(0, w, 2)]
        return self._tables

    def log_probabilities(self, x: np.ndarray, block: int = 64) -> np.ndarray:
        """Of each class for each window, block by block so that a block stays in the processor's cache."""
        tables, out = self.tables(), np.empty((len(x), len(self.classes)), np.float32)
        for at in range(0, len(x), block):
            part = x[at : at + block].astype(np.int32)
            pairs = np.ascontiguousarray(((part[:, :-1] << 8) | part[:, 1:]).T)  # places first: the maximum runs over whole rows
            pooled = []
            for w in WIDTHS:
                m = len(pairs) - w + 2
                z = np.take(tables[w][0], pairs[:m], axis=0, mode="clip")
                for j in range(1, w // 2):
                    z += np.take(tables[w][j], pairs[2 * j : 2 * j + m], axis=0, mode="clip")
                pooled.append(np.maximum(z.max(0) + self.bias[w], 0))
            z = np.concatenate(pooled, 1) @ self.dense + self.offset
            z -= z.max(1, keepdims=True)
            out[at : at + block] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def sentences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, starts, ends, text of each sentence)."""
    raw = [(t or "").encode("utf-8", "replace").replace(b"\0", b" ") for t in texts]
    joined = b"\n".join(raw) + b"\n"
    marks = [(m.start(), m.end()) for m in _SENTENCE.finditer(joined)]
    cut = np.asarray([e for _, e in marks], np.int64)
    stop = np.asarray([s for s, _ in marks], np.int64)
    starts, ends = np.r_[0, cut[:-1]].astype(np.int64), stop
    text_ends = np.cumsum([len(x) + 1 for x in raw])
    keep = ends > starts
    starts, ends = starts[keep], ends[keep]
    return np.frombuffer(joined, np.uint8), starts, ends, np.searchsorted(text_ends, starts, "right")


def word_counts(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of each sentence; bytes above 127 count as letters.

    Words of one letter count up to half as many as there are longer ones, so that lists of letters are no prose. In
    scripts without spaces, which write a character in three bytes from 0xE3 on, two characters count as a word.
    """
    letter = ((buffer | 32) >= 97) & ((buffer | 32) <= 122) | (buffer >= 128)
    before, after = np.r_[False, letter[:-1]], np.r_[letter[1:], False]
    second = letter & before & ~np.r_[False, False, letter[:-2]]  # the second letter of a word
    dense = (buffer >= 0xE3) & (buffer <= 0xED)

    def held(marks: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(marks)]
        return total[ends] - total[starts]

    long = held(second)
    return long + np.minimum(held(letter & ~before & ~after), long // 2) + held(dense) // 2


def train(documents: DataFrame, lang_codes: DataFrame, sample: int = SAMPLE, windows_each: int = WINDOWS_EACH, epochs: int = EPOCHS, seed: int = 1) -> ByteNet | None:
    """The network, trained on about `sample` labelled documents of each language, taken by a hash of their text.

    As some labels are wrong and some texts mixed, a first network is trained on all windows, weighted as in the corpus,
    where most labels of any one language's windows are right. Windows whose label it does not believe are left out, and
    a second one is trained on the rest, all languages alike. None where no label names a language.
    """
    codes = code_table(lang_codes)
    labelled = documents.select(label_code(F.col("lang"), codes).alias("code"), "text").where("code IS NOT NULL AND text IS NOT NULL")
    counts = {r["code"]: r["count"] for r in labelled.groupBy("code").count().collect()}  # at most one row a language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))])
    chance = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = labelled.withColumn("chance", chance).where(F.col("chance") < F.element_at(share, F.col("code")))
    first_of = F.row_number().over(Window.partitionBy("code").orderBy("chance", F.xxhash64("text")))
    bounded = drawn.withColumn("n", first_of).where(F.col("n") <= 2 * sample).select("code", "text")  # copies of one text are drawn together
    rows = bounded.mapInPandas(_training_windows(windows_each, seed), "code string, bytes binary").collect()
    classes = sorted(counts)
    rows.sort(key=lambda r: (bytes(r["bytes"]), r["code"]))
    x = np.frombuffer(b"".join(bytes(r["bytes"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    y = np.asarray([classes.index(r["code"]) for r in rows])
    if not len(x):
        return None
    taken = np.bincount(y, minlength=len(classes))
    held = np.asarray([counts[c] for c in classes], np.float32)
    first = ByteNet(classes, seed).fit(x, y, max(2, epochs // 2), (held / np.maximum(taken, 1))[y])
    believed = first.log_probabilities(x)[np.arange(len(x)), y] > np.log(0.5)
    x, y = x[believed], y[believed]
    taken = np.bincount(y, minlength=len(classes))
    return ByteNet(classes, seed + 1).fit(x, y, epochs, (1 / np.maximum(taken, 1))[y])


def _training_windows(windows_each: int, seed: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, out = batch["code"].tolist(), []
            buffer, starts, ends, owner = sentences(batch["text"].tolist())
            long = word_counts(buffer, starts, ends) >= LEAST_WORDS
            starts, ends, owner = starts[long], ends[long], owner[long]
            if len(starts):
                x, sentence = windows(buffer, starts, ends)
                for t in np.unique(owner):
                    mine = np.flatnonzero(owner[sentence] == t)
                    r = np.random.default_rng([seed, len(mine), int(x[mine[0]].astype(np.int64).sum())])
                    out += [(codes[t], x[k].tobytes()) for k in r.permutation(mine)[:windows_each]]
            yield pd.DataFrame(out, columns=["code", "bytes"])

    return make


def segments(documents: DataFrame, net: ByteNet | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, segments): for each document the languages of its prose, as an array of
    (segment_no, lang, confidence, n_sentences, n_words, sure), one for each stretch of sentences in one language.

    Sentences of fewer than LEAST_WORDS words speak for none and do not part a stretch. Null, empty and wordless texts
    have an empty array, and all have with no network.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(net)
    kind = documents.schema[key].dataType
    part = T.StructType([T.StructField("segment_no", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("n_sentences", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("sure", T.BooleanType())])
    schema = T.StructType([T.StructField(key, kind), T.StructField("segments", T.ArrayType(part))])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for batch in slices(whole, text, 1_000_000):  # bounded arrays, whatever the batch
                yield pd.DataFrame({key: batch[key].to_numpy(), "segments": _segments(sent.value, batch[text].tolist())})

    return documents.select(key, text).mapInPandas(find, schema)


def _segments(net: ByteNet | None, texts: list[str | None]) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in texts]
    if net is None:
        return out
    buffer, starts, ends, owner = sentences(texts)
    words = word_counts(buffer, starts, ends)
    prose = words >= LEAST_WORDS
    starts, ends, owner, words = starts[prose], ends[prose], owner[prose], words[prose]
    if not len(starts):
        return out
    score = np.zeros((len(starts), len(net.classes)))
    count = np.zeros(len(starts))
    for at in range(0, len(starts), 20_000):
        x, sentence = windows(buffer, starts[at : at + 20_000], ends[at : at + 20_000])
        np.add.at(score, sentence + at, net.log_probabilities(x))
        np.add.at(count, sentence + at, 1)
    score /= count[:, None] ** 0.5  # windows of one sentence are not independent
    p = np.exp(score - score.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    lang, sure = p.argmax(1), p.max(1)
    new = np.r_[True, (owner[1:] != owner[:-1]) | (lang[1:] != lang[:-1])]
    first = np.flatnonzero(new)
    for i, j in zip(first, np.r_[first[1:], len(lang)]):
        mine = out[owner[i]]
        mine.append({"segment_no": len(mine), "lang": net.classes[lang[i]], "confidence": float(sure[i:j].mean()), "n_sentences": int(j - i), "n_words": int(words[i:j].sum()), "sure": bool(sure[i:j].max() >= SURE)})
    return out


def languages(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, lang, confidence, n_sentences, n_words): the languages of each document out of its segments.

    The language with the most words counts always, every other one where at least one whole sentence is surely in it.
    Documents without prose have no row. Repeated keys are one document; a key may be a struct that tells them apart.
    """
    by = found.select(key, F.explode("segments").alias("s")).groupBy(key, "s.lang").agg(
        (F.sum(F.col("s.confidence") * F.col("s.n_sentences")) / F.sum("s.n_sentences")).alias("confidence"), F.sum("s.n_sentences").alias("n_sentences"),
        F.sum("s.n_words").alias("n_words"), F.max("s.sure").alias("sure"),
    )
    row = F.struct("n_words", "lang", "confidence", "n_sentences", "sure")
    texts = by.groupBy(key).agg(F.collect_list(row).alias("all"), F.max(F.struct("n_words", "lang")).alias("main"))  # at most one for each language
    spoken = F.filter("all", lambda x: x["sure"] | (x["lang"] == F.col("main.lang")))
    return texts.select(key, F.explode(spoken).alias("x")).select(key, "x.lang", "x.confidence", "x.n_sentences", "x.n_words")


def mislabelled(documents: DataFrame, lang_codes: DataFrame, net: ByteNet | None = None, **training) -> DataFrame:
    """(doc_id, lang): documents with prose whose label is missing, names a language the text is not in, or whose text
    holds several languages; one row for each language of the text. Labels that spell the right language in another way
    are right. Repeated ids are told apart by their text.
    """
    net = net or train(documents, lang_codes, **training)
    codes = code_table(lang_codes)
    rows = documents.select("doc_id", "text", label_code(F.col("lang"), codes).alias("label"))
    tagged = rows.select(F.struct("doc_id", "label", F.xxhash64("text").alias("same")).alias("row"), "text")
    spoken = languages(cut(segments(tagged, net, "row"), "segments"), "row")
    named = spoken.groupBy("row").agg(F.collect_list("lang").alias("langs"))
    right = (F.size("langs") == 1) & F.coalesce(F.array_contains("langs", F.col("row.label")), F.lit(False))
    return named.where(~right).select(F.col("row.doc_id").alias("doc_id"), F.explode("langs").alias("lang")).distinct()
