"""Problem 2: text that was decoded with the wrong encoding.

Every word with characters beyond ASCII (or entities) has candidate readings: itself, and what comes out when a chain of
wrong decodings is undone. Which chain a word went through is latent. Expectation-maximization pools the evidence: a word
is weak evidence by itself, but words of one source and field mostly went through the same chains. The E step gives each
word's chains a posterior out of the likelihood of its reading and the source's weights of the chains; the M step makes
the weights anew from the posteriors, smoothed by those of the whole corpus. Each record is then repaired with the
readings of highest posterior.

The likelihood of a reading has three parts: bytes that happen to form valid UTF-8 are hardly an accident (a fixed gain
for each sequence), a reading that many sources have is likelier than one that few have, and characters that the corpus
hardly has, or several accented Latin letters in a row, are unlikely. Where characters were lost, the words of the corpus are put through the same losses, and a word
that comes out the same is a reading.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

# Encodings that text is mistaken for, in the order in which they are tried.
SINGLE = ("cp1252", "latin-1", "mac_roman", "cp1251", "cp437", "cp850", "koi8-r", "cp866")
DOUBLE = ("gbk", "big5", "shift_jis", "euc_kr")
#: 8-bit text read as another 8-bit encoding: (read as, really).
PAIRS = (("cp1252", "cp1251"), ("latin-1", "cp1251"), ("cp1251", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp1252", "koi8-r"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"))
GAIN, LOST_GAIN, LONG_PENALTY, RARE_PENALTY, ROUNDS, SMOOTHING = 5.0, 3.0, 0.5, 6.0, 4, 5.0
#: Least weight of a chain.
FLOOR = 1e-6
#: Least part of all characters beyond ASCII that a usual character has; so there are at most 50,000 of them.
USUAL_PART = 2e-5

_TOKEN = re.compile(r"[^ \n\t\r]+")
_ENTITY = re.compile(r"&(?:#\d{2,7}|#x[0-9A-Fa-f]{2,6}|[A-Za-z][A-Za-z0-9]{1,7});")
_EDGE = re.compile(r"^[!-/:-@\[-`{-~“”‘’«»¿¡।]+|[!-/:-@\[-`{-~“”‘’«»।]+$")
_DIGITS = re.compile("[0-9]+")
LOST = "\ufffd"
SELF = "as is"


@lru_cache(maxsize=None)
def _bytes_of(codec: str) -> dict[str, int]:
    """Character -> byte; bytes the encoding leaves open stand for the control character of the same number."""
    out = {}
    for b in range(256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


def _encode(text: str, codec: str) -> bytes | None:
    if codec in DOUBLE:
        try:
            return text.encode(codec)
        except UnicodeEncodeError:
            return None
    table = _bytes_of(codec)
    try:
        return bytes([table[c] for c in text])
    except KeyError:
        return None


def _decode(raw: bytes, codec: str) -> str | None:
    try:
        return raw.decode(codec)
    except UnicodeDecodeError:
        return None


def undo_once(word: str) -> list[tuple[str, str, float]]:
    """(step, reading, gain) of each wrong decoding that can be undone on a whole word."""
    out, seen = [], {word}
    cjk = any("⺀" <= c <= "鿿" or "가" <= c <= "힣" or "一" <= c or "①" <= c <= "⓿" for c in word)
    for codec in (*SINGLE, *DOUBLE) if cjk else SINGLE:
        raw = _encode(word, codec)
        if raw is None:
            continue
        reading = _decode(raw, "utf-8")
        if reading is not None and reading not in seen:
            seen.add(reading)
            out.append((codec, reading, GAIN * sum(ord(c) > 127 for c in reading)))
    return out


def undo_runs(word: str) -> list[tuple[str, str, float]]:
    """The same for words of which only some runs are garbled: each run of characters beyond ASCII by itself."""
    out = []
    for codec in SINGLE:
        gained = 0

        def fix(m: re.Match, codec: str = codec) -> str:
            nonlocal gained
            raw = _encode(m[0], codec)
            reading = _decode(raw, "utf-8") if raw is not None else None
            if reading is None:
                return m[0]
            gained += sum(ord(c) > 127 for c in reading)
            return reading

        reading = re.sub(r"[^\x00-\x7f]+", fix, word)
        if gained:
            out.append((codec + " in places", reading, GAIN * gained))
    return out


def readings(word: str) -> list[tuple[str, str, float]]:
    """(chain, reading, gain) of a word, itself first; each reading once, by its shortest chain."""
    found = {word: (SELF, 0.0)}
    todo = [((), word, 0.0)]
    unescaped = html.unescape(word) if "&" in word and _ENTITY.search(word) else word
    if unescaped != word:
        todo = [(("entities",), unescaped, 0.0)]
    depth = 0
    while todo:  # each step leaves a shorter text
        new = []
        for chain, text, gain in todo:
            if text.isascii():
                continue
            steps = undo_once(text) or undo_runs(text)
            if depth == 0 and not steps and LOST not in text:
                steps = [(f"{a} for {b}", r, 0.0) for a, b in PAIRS if (raw := _encode(text, a)) is not None and (r := _decode(raw, b)) is not None and r != text]
            for step, reading, g in steps:
                if reading not in found:
                    found[reading] = (" < ".join((*chain, step)), gain + g - LONG_PENALTY * len(chain))
                    if " for " not in step:
                        new.append(((*chain, step), reading, gain + g))
        todo, depth = new, depth + 1
    return [(chain, reading, gain) for reading, (chain, gain) in found.items()]


def suspicious(token: str) -> bool:
    return not token.isascii() or (("&" in token) and _ENTITY.search(token) is not None)


def core(word: str) -> str:
    """A word without punctuation at its ends, in lower case, any figures written as 0; the word itself where nothing is left."""
    return _DIGITS.sub("0", _EDGE.sub("", word).lower()) or word


def losses(word: str) -> set[str]:
    """What a word becomes by wrong decodings that lose characters."""
    raw = word.encode("utf-8", "replace")
    out = {"".join(chr(b) for b in raw if not 0x80 <= b < 0xA0), raw.decode("gbk", "replace"), raw.decode("cp1252", "replace"), raw.decode("cp1252", "ignore"), raw.decode("cp1251", "replace")}
    for codec in ("cp1252", "cp1251", "mac_roman"):
        try:
            out.add(word.encode(codec).decode("utf-8", "replace"))
        except UnicodeEncodeError:
            pass
    return {x for x in out if x != word and x.strip(LOST) and not x.isascii()}


def with_digits(form: str, word: str) -> str | None:
    """A form whose digits are written as 0 with the digits of a word; None where their number differs."""
    digits = [c for c in word if "0" <= c <= "9"]
    return re.sub("0", lambda _: digits.pop(0), form) if form.count("0") == len(digits) else None


def source_key(source: Column) -> Column:
    """A source as a key that is never null: joins drop null keys, and a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def suspicious_words(df: DataFrame, text: str = "text", source: str = "source_rel") -> DataFrame:
    """(source, word, n): the suspicious words of each source, counted inside the tasks before the shuffle."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words: Counter = Counter()
            for s, t in zip(batch["source"], batch["text"]):
                if t and (not t.isascii() or "&" in t):
                    words.update((s, w) for w in _TOKEN.findall(t) if suspicious(w))
            yield pd.DataFrame([(s, w, n) for (s, w), n in words.items()], columns=["source", "word", "n"])

    slim = df.select(source_key(F.col(source)).alias("source"), F.col(text).alias("text"))
    return slim.mapInPandas(scan, "source string, word string, n long").groupBy("source", "word").agg(F.sum("n").alias("n"))


def with_options(words: DataFrame) -> DataFrame:
    """(word, sources, n, options): each distinct word with its readings."""

    @F.pandas_udf("array<struct<chain:string,reading:string,gain:double,core:string>>")
    def options(batch: pd.Series) -> pd.Series:
        return pd.Series([[{"chain": c, "reading": r, "gain": g, "core": core(r)} for c, r, g in readings(w)] for w in batch])

    return words.withColumn("options", options("word"))


def _rated(words: DataFrame) -> DataFrame:
    """(word, options): the readings of each word that are left, as an array of (chain, reading, fit)."""
    strict = words.where(~F.exists("options", lambda o: o["gain"] > 0) & ~F.col("word").contains(LOST))
    chars = strict.select(F.explode(F.split("word", "")).alias("c"), "n").where(F.ascii("c") > 127).groupBy("c").agg(F.sum("n").alias("n"))
    share = chars.crossJoin(F.broadcast(chars.agg(F.sum("n").alias("whole")))).where(F.col("n") >= USUAL_PART * F.col("whole"))  # one row
    usual = "".join(sorted(r["c"] for r in share.select("c").collect())) or " "

    def rare(reading):
        return F.length(F.translate(F.regexp_replace(reading, r"[\x00-\x7f]", ""), usual, ""))

    # a word that no wrong decoding of UTF-8 explains in usual characters may be clean: how many sources have it tells
    clean = cut(words.where(~F.exists("options", lambda o: (o["gain"] > 0) & (rare(o["reading"]) == 0))).select("word", "sources", F.element_at("options", 1)["core"].alias("core")), "clean")
    spread = clean.groupBy("core").agg(F.sum("sources").alias("seen"))
    options = words.where(F.size("options") > 1).select("word", F.explode("options").alias("o")).select("word", "o.*")
    rated = options.unionByName(_lossy(words, clean)).join(spread, "core", "left")
    fit = F.col("gain") + 2 * F.log(F.coalesce(F.col("seen"), F.lit(0)) + F.lit(0.5)) - RARE_PENALTY * rare(F.col("reading")) - F.greatest(F.regexp_count("reading", F.lit("[À-ÿ](?=[À-ÿ])")) - 1, F.lit(0))
    each = rated.select("word", "reading", "chain", fit.alias("fit")).repartition("word").groupBy("word", "reading").agg(F.max_by("chain", F.struct("fit", "chain")).alias("chain"), F.max("fit").alias("fit"))
    arrays = each.groupBy("word").agg(F.collect_list(F.struct("chain", "reading", "fit")).alias("options"), F.max("fit").alias("top"))
    # no weight can make up for a fit this far below the best one
    return arrays.select("word", F.filter("options", lambda o: o["fit"] >= F.col("top") + F.log(F.lit(FLOOR))).alias("options"))


def decide(df: DataFrame, text: str = "text", source: str = "source_rel", rounds: int = ROUNDS) -> DataFrame:
    """(source, word, chain, reading, posterior): the reading of highest posterior of every word that has several.

    What a word may be read as does not depend on its source, so readings and their fit are worked out once for each
    distinct word; only the weights of the chains are learned for each source. Words of one source with the same chains
    and fits are one row in the rounds, and all that a round writes is the mass of each source's chains. `source` comes
    as source_key has it.
    """
    seen = cut(suspicious_words(df, text, source), "words")
    words = cut(with_options(seen.groupBy("word").agg(F.count("*").alias("sources"), F.sum("n").alias("n"))), "options")
    told = cut(seen.join(_rated(words), "word"), "readings")
    alone = F.size("options") == 1
    pattern = F.transform("options", lambda o: F.struct(o["chain"].alias("chain"), F.when(alone, 0.0).otherwise(o["fit"]).alias("fit")))
    lean = cut(told.groupBy("source", pattern.alias("options")).agg(F.sum("n").alias("n")), "patterns")

    def scored(rows: DataFrame, weights: tuple[DataFrame, DataFrame] | None) -> DataFrame:
        """Rows with `scores`, the logarithm of each option's prior and likelihood, and their greatest, `top`."""
        if weights is None:
            prior = lambda o: F.when(o["chain"] == SELF, 0.5).otherwise(0.1)
        else:
            rows = rows.join(weights[0], "source").crossJoin(F.broadcast(weights[1]))  # one row
            smooth = lambda o: F.coalesce(F.try_element_at("own", o["chain"]), F.lit(0.0)) + SMOOTHING * F.coalesce(F.try_element_at("base", o["chain"]), F.lit(0.0))
            prior = lambda o: smooth(o) / (F.col("total") + SMOOTHING)
        scores = F.transform("options", lambda o: o["fit"] + F.log(F.greatest(prior(o), F.lit(FLOOR))))
        return rows.withColumn("scores", scores).withColumn("top", F.array_max("scores"))

    parts = F.transform("scores", lambda s: F.exp(s - F.col("top")))
    weights = None
    for _ in range(rounds - 1):
        post = scored(lean, weights).withColumn("parts", parts)
        whole = F.aggregate("parts", F.lit(0.0), lambda a, b: a + b)
        mass = post.select("source", F.explode(F.zip_with("options", "parts", lambda o, p: F.struct(o["chain"].alias("chain"), (F.col("n") * p / whole).alias("mass")))).alias("m"))
        mass = cut(mass.groupBy("source", "m.chain").agg(F.sum("m.mass").alias("mass")), "mass")
        own = mass.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("chain", "mass"))).alias("own"), F.sum("mass").alias("total"))
        of_chain = mass.groupBy("chain").agg(F.sum("mass").alias("mass")).agg(F.collect_list(F.struct("chain", "mass")).alias("all"), F.sum("mass").alias("every"))
        base = of_chain.select(F.map_from_entries(F.transform("all", lambda c: F.struct(c["chain"], (c["mass"] + 0.01) / (F.col("every") + 1)))).alias("base"))
        weights = (own, base)
    open_ = scored(told.where(~alone), weights)
    best = F.array_max(F.zip_with("options", "scores", lambda o, s: F.struct(s.alias("score"), o["chain"].alias("chain"), o["reading"].alias("reading"))))
    posterior = 1 / F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    chosen = open_.withColumn("best", best).select("source", "word", "best.chain", "best.reading", posterior.alias("posterior"))
    only = F.element_at("options", 1)
    return chosen.unionByName(told.where(alone).select("source", "word", only["chain"].alias("chain"), only["reading"].alias("reading"), F.lit(1.0).alias("posterior")))


def _lossy(words: DataFrame, clean: DataFrame) -> DataFrame:
    """Readings of words in which characters may be lost: words of the corpus that the same loss makes equal to them."""
    zeros = F.regexp_replace("word", "[0-9]", "0")

    @F.pandas_udf("array<string>")
    def lost(forms: pd.Series) -> pd.Series:
        return pd.Series([sorted(losses(w)) for w in forms])

    @F.pandas_udf("string")
    def fill(forms: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([with_digits(f, w) for f, w in zip(forms, words)])

    @F.pandas_udf("string")
    def cores(words: pd.Series) -> pd.Series:
        return words.map(core)

    forms = clean.where(~F.col("word").contains(LOST) & ~F.col("word").contains("&")).groupBy(zeros.alias("form")).agg(F.sum("sources").alias("df"))
    keys = forms.select("form", "df", F.explode(lost("form")).alias("zeros")).groupBy("zeros").agg(F.max_by("form", F.struct("df", "form")).alias("form"))
    torn = words.select("word", zeros.alias("zeros"), F.element_at("options", 1)["core"].alias("own"))
    told = torn.join(keys, "zeros").withColumn("reading", fill("form", "word")).where("reading IS NOT NULL AND reading <> word").withColumn("core", cores("reading"))
    names = ["word", "chain", "reading", "gain", "core"]
    itself = told.select("word", F.lit(SELF).alias("chain"), F.col("word").alias("reading"), F.lit(0.0).alias("gain"), F.col("own").alias("core"))
    return told.withColumns({"chain": F.lit("lost characters"), "gain": F.lit(LOST_GAIN)}).select(names).unionByName(itself)


def repaired(df: DataFrame, key: str = "page_id", text: str = "text", source: str = "source_rel", rounds: int = ROUNDS) -> DataFrame:
    """(key, text, places, lost, chains): each record with its original text as far as it can be recovered.

    places counts the words that were repaired, lost those in which characters are gone for good (U+FFFD) and of which
    no other word of the corpus tells what they were; chains names the decodings undone. Null stays null, a record
    without a case keeps its text, a null source is a source of its own, and repeated records are repaired alike.
    """
    decisions = decide(df, text, source, rounds).where(F.col("chain") != SELF).select("source", "word", "chain", "reading")
    slim = df.select(F.col(key).alias("_key"), source_key(F.col(source)).alias("source"), F.col(text).alias("_text"))
    odd = F.coalesce(F.col("_text").rlike(r"[^\x00-\x7f]|&[#A-Za-z]"), F.lit(False))

    @F.pandas_udf("array<string>")
    def words(t: pd.Series) -> pd.Series:
        return pd.Series([sorted({w for w in _TOKEN.findall(x) if suspicious(w)}) for x in t])

    @F.pandas_udf("text string, places int, lost int, chains array<string>")
    def rewrite(t: pd.Series, pairs: pd.Series) -> pd.DataFrame:
        out = []
        for x, p in zip(t, pairs):
            known = {y["word"]: (y["reading"], y["chain"]) for y in (p if p is not None else [])}
            places, chains = 0, set()

            def put(m: re.Match) -> str:
                nonlocal places
                hit = known.get(m[0])
                if hit is None:
                    return m[0]
                places += 1
                chains.add(hit[1])
                return hit[0]

            new = _TOKEN.sub(put, x) if known else x
            out.append((new, places, sum(LOST in w for w in _TOKEN.findall(new)) if LOST in new else 0, sorted(chains)))
        return pd.DataFrame(out, columns=["text", "places", "lost", "chains"])

    rows = slim.where(odd).withColumn("_row", F.xxhash64("source", "_text"))
    used = rows.select("_row", "source", F.explode(words("_text")).alias("word")).distinct()
    done = rows.join(_hits(used, decisions), "_row", "left").withColumn("_new", rewrite("_text", "_pairs"))
    changed = done.select(F.col("_key").alias(key), "_new.*")
    same = slim.where(~odd).select(F.col("_key").alias(key), F.col("_text").alias("text"), F.lit(0).alias("places"), F.lit(0).alias("lost"), F.array().cast("array<string>").alias("chains"))
    return same.unionByName(changed)


def _hits(used: DataFrame, decisions: DataFrame) -> DataFrame:
    """The decisions on each row's words, as one array."""
    hit = used.join(decisions, ["source", "word"])
    return hit.groupBy("_row").agg(F.collect_list(F.struct("word", "reading", "chain")).alias("_pairs"))


def garbled(df: DataFrame, key: str = "page_id", text: str = "text", source: str = "source_rel", rounds: int = ROUNDS) -> DataFrame:
    """(key): records with at least one place that was decoded with the wrong encoding, recovered or lost."""
    return repaired(df, key, text, source, rounds).where("places > 0 OR lost > 0").select(key).distinct()
