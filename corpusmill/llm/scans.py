"""Problem 5: noise in the text of scanned pages.

Headers and footers are lines at the edges of pages that come back within a file, misread characters aside: lines are
compared by their shape, in which characters that scanners take for each other are written alike, and shapes that differ
from a running line's in few characters join it. Page numbers are
figures at the edges that run along with the pages of the file. Words cut at line ends are judged by the corpus
vocabulary: joined where the joined word is known, kept where the compound with its own hyphen is. A word is misread where
the corpus knows, among the words of its shape, one that is far more frequent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, looked_up, slices

EDGE, LEAST_PAGES, RARER, KNOWN, COMMON = 3, 3, 20, 3, 50_000
BODY_SHARE, FULL = 0.8, 0.8
#: Characters of a line's shape for each that may differ in a fuzzy repetition, and those that must agree at either end.
FUZZY, AGREE = 10, 8

# What scanners take for each other, each written as the smaller parts that it may fall into.
PARTS = {
    "m": "rn", "w": "vv", "d": "ci", "u": "ii", "h": "ii", "b": "ii", "0": "o", "1": "i", "l": "i", "!": "i", "|": "i",
    "5": "s", "8": "ii", "9": "g", "@": "a", "e": "c", "f": "t",
}
FIGURES = str.maketrans({"l": "1", "I": "1", "|": "1", "i": "1", "O": "0", "o": "0", "S": "5", "s": "5"})
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}

LOST = "\ufffd"
_TOKEN = re.compile(r"[\w@|!\ufffd]+")
_NOT_LETTER, _NOT_WORD = re.compile(r"[\W\d_]+"), re.compile(r"[\W_]+")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_NUMBER = re.compile(r"(?=.*\d)(?=.*[lOSI|o])[\dlOSI|o]+")
_NUMERAL = re.compile(r"(?=.)c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_MARKED = re.compile(r"[\[\](){}—–|-]|page|pg|p\.", re.I)
_NUMERALS = r"[0-9lIOS|]{1,5}|[ivxlc]{1,9}"
_ALONE = re.compile(rf"[\W_]*(?:(?:page|pg|p)\.?\s*)?(?P<n>{_NUMERALS})(?:\s*(?:of|/)\s*[0-9lIOS|]{{1,5}})?[\W_]*", re.I)
_FIRST = re.compile(rf"[\W_]*(?P<n>{_NUMERALS})(?P<gap>[\W_]+)")
_LAST = re.compile(rf"(?P<gap>[\W_]+)(?:(?:page|pg|p)\.?\s*)?(?P<n>{_NUMERALS})[\W_]*$", re.I)
_SPACED, _BARRED, _LETTER, _FIGURE = re.compile(r"\s"), re.compile(r"[\s|\-–—]"), re.compile(r"[^\W\d_]"), re.compile(r"\d")
_CUT = re.compile("[-\u2010\u00ad¬–=~][ \t\r\f\v]*\n")
_END = re.compile(r"(?P<left>[^\W\d_](?:[\w@|!]|-(?=\w))*)(?P<mark>[-\u2010\u00ad¬–=~])\s*$")
MARKS = frozenset("-\u2010\u00ad¬–=~")
_NEXT = re.compile(r"\s*(?P<right>[^\W\d_][\w@|!]*)")


def shape(text: str) -> str:
    """A text with all characters that scanners confuse written alike; equal shapes may be readings of one text."""
    text = text.lower()
    for c, parts in PARTS.items():  # no part is a key, so one after the other is all at once
        text = text.replace(c, parts)
    return text


def wording(line: str) -> str:
    """The shape of a line's letters: what is left without figures, spaces and punctuation."""
    for c in "@!|":
        line = line.replace(c, PARTS[c])
    return shape(_NOT_LETTER.sub("", line))


def number(label: str) -> int | None:
    """The value of a printed page number, Arabic or Roman, misread figures included."""
    low = label.lower()
    if any(c.isdigit() for c in label) or not _NUMERAL.fullmatch(low):
        plain = label.translate(FIGURES)
        return int(plain) if plain.isdigit() else None
    total, last = 0, 0
    for c in reversed(low):
        v = _ROMAN[c]
        total += v if v >= last else -v
        last = max(last, v)
    return total


def edge_places(lines: list[str]) -> list[tuple[int, int, int]]:
    """(line, lines with text above it, lines with text below it) of the first and last lines of a page with text."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    last = len(full) - 1
    return [(full[k], k, last - k) for k in range(len(full)) if k < EDGE or last - k < EDGE]


def numbered_line(line: str) -> tuple[str, int] | None:
    """(what else a line says, number) of a line with letters that a number opens or closes."""
    if not _FIGURE.search(line):
        return None
    m = _FIRST.match(line)
    if m and _SPACED.search(m["gap"]) and _FIGURE.search(m["n"]) and (n := number(m["n"])) is not None and _LETTER.search(line, m.end()):
        return line[m.end() :], n
    m = _LAST.search(line)
    if m and _BARRED.search(m["gap"]) and _FIGURE.search(m["n"]) and (n := number(m["n"])) is not None and _LETTER.search(line, 0, m.start()):
        return line[: m.start()], n
    return None


def edge_lines(lines: list[str]) -> Iterator[tuple]:
    """(line_no, top, bottom, key, body, number, alone, marked) of the first and last lines of a page that are not blank,
    with their shape and the numbers they may hold.

    A line that may be a lone page number comes as a row of its own, with the number of lines above and below it; whether
    it counts is seen when the running lines are known. Unless it is the outermost line it has a row of its wording too.
    """
    width = max(map(len, lines), default=0)
    for i, top, bottom in edge_places(lines):
        line = lines[i].strip()
        m = _ALONE.fullmatch(line)
        if m:
            label, marked = m["n"], _MARKED.search(line) is not None
            # figures by themselves may be a table's; marks around them, or Roman numerals, make a page number likelier
            roman = not _FIGURE.search(label) and _NUMERAL.fullmatch(label.lower()) is not None
            if marked or line[-1] not in ".,;:?!":  # else the end of a sentence
                yield i, top, bottom, "", False, number(label), True, roman or marked
            if not top or not bottom:
                continue
        rest, found = numbered_line(line) or (None, None)
        body = line[-1] in ".?!,;।”" or line[0].islower() or (len(line) > 30 and len(line) >= FULL * width)  # reads like text
        yield i, top, bottom, wording(line) if rest is None else _NOT_WORD.sub("", shape(rest)), body, found, False, False


def first_pass(pages: DataFrame) -> DataFrame:
    """What one reading of the texts gives, told apart by `kind`: edge lines ("edge") and the task's counts of words
    ("word": word, shape, n and those off scanned pages, clean)."""
    kind = pages.schema["page"].dataType.simpleString()
    edge = "line_no int, top int, bottom int, key string, body boolean, number int, alone boolean, marked boolean"
    schema = f"kind string, page {kind}, file string, page_num int, {edge}, word string, shape string, n long, clean long"
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, clean = Counter(), Counter()

        def words() -> pd.DataFrame:
            rows = [("word", *[None] * 11, w, shape(w), n, clean[w]) for w, n in every.items() if _is_word(w)]
            every.clear()
            clean.clear()
            return pd.DataFrame(rows, columns=names)

        for batch in (part for whole in batches for part in slices(whole, "text")):
            edges = []
            for p, f, at, method, t in zip(batch["page"], batch["file"], batch["page_num"], batch["method"], batch["text"]):
                if not t:
                    continue
                lines = t.split("\n")
                edges += [("edge", p, f, at, *e, None, None, None, None) for e in edge_lines(lines)]
                found = whole_words(t, lines, _broken(lines) if _CUT.search(t) else [])
                every.update(found)
                if method and method != "ocr":
                    clean.update(found)
            rows = pd.DataFrame(edges, columns=names)
            yield rows.assign(number=rows["number"].astype("Int64"))
            if len(every) > 200_000:
                yield words()
        yield words()

    return pages.mapInPandas(read, schema)


def furniture(lines: DataFrame, size: DataFrame) -> DataFrame:
    """(page, line_no, kind) of running lines and page numbers out of edge lines and (file, pages).

    Lines of one key in a file are one line. A key on too few pages joins a running line of its file from which it differs
    in at most one character of FUZZY, where they agree in their first or last AGREE characters.
    """
    keyed = lines.where(F.length("key") >= 4)
    counts = keyed.select("file", "key", "body", "page_num").distinct().groupBy("file", "key").agg(F.countDistinct("page_num").alias("on"), F.min("body").alias("body")).join(size, "file")
    running = (F.col("on") >= LEAST_PAGES) & (~F.col("body") | (F.col("on") >= BODY_SHARE * F.col("pages")))
    keys = cut(counts.select("file", "key", running.alias("running")), "keys")
    firm, loose = keys.where("running").select("file", F.col("key").alias("firm")), keys.where(~F.col("running") & (F.length("key") >= AGREE))
    ends = lambda c: F.explode(F.array(F.concat(F.lit("<"), F.substring(c, 1, AGREE)), F.concat(F.lit(">"), F.expr(f"right({c}, {AGREE})")))).alias("end")
    near = loose.select("file", "key", ends("key")).join(firm.select("file", "firm", ends("firm")), ["file", "end"])
    near = near.where(F.levenshtein("key", "firm") * FUZZY <= F.least(F.length("key"), F.length("firm"))).select("file", "key")
    ran = cut(firm.select("file", F.col("firm").alias("key")).unionByName(near).distinct(), "running")
    run_lines = looked_up(keyed, ran, ["file", "key"], F.col("page"), ran.count())

    # a lone number counts where only running lines stand between it and an edge of the page
    around = run_lines.groupBy("page").agg(F.collect_set("top").alias("tops"), F.collect_set("bottom").alias("bottoms"))
    free = [f"{x} < {EDGE} AND size(filter(coalesce({x}s, array()), y -> y < {x})) = {x}" for x in ("top", "bottom")]
    lone = lines.where("number IS NOT NULL AND alone").join(around, "page", "left").where(" OR ".join(free))
    columns = ["page", "file", "page_num", "line_no", "number", "alone", "marked"]
    numbered = lone.select(columns).unionByName(run_lines.where("number IS NOT NULL").select(columns))
    steps = numbered.withColumn("step", F.col("number") - F.col("page_num"))
    support = steps.select("file", "step", "page_num").distinct().groupBy("file", "step").agg(F.count("*").alias("along"))
    told = steps.join(support, ["file", "step"])
    is_number = (F.col("along") >= 2) | (F.col("alone") & F.col("marked"))
    return (
        run_lines.select("page", "line_no", F.lit("running_line").alias("kind"))
        .unionByName(told.where(is_number).select("page", "line_no", F.lit("page_number").alias("kind")))
        .distinct()
    )


def _body(text: str, skip: set[int]) -> list[tuple[int, str]]:
    """(number, line) of the lines that stay."""
    return [(i, x) for i, x in enumerate(text.split("\n")) if i not in skip]


def whole_words(text: str, lines: list[str], broken: list[tuple[int, str, str, str]]) -> list[str]:
    """Lower-case tokens of a page that are whole (not those at a broken line end or after it), and its compounds."""
    if broken:
        lines = list(lines)
        for i, left, mark, right in broken:
            lines[i] = lines[i].rstrip()[: -len(left) - 1]
            lines[i + 1] = lines[i + 1].lstrip()[len(right) :]
        text = "\n".join(lines)
    text = text.lower()
    words = _TOKEN.findall(text)
    for w in text.split() if "-" in text else ():
        if "-" in w:
            words += _COMPOUND.findall(w)
    return words


def _is_word(token: str) -> bool:
    """Figures are no words, and characters lost by a wrong decoding are no misreading."""
    return not token.isdigit() and LOST not in token


def _broken(lines: list[str]) -> list[tuple[int, str, str, str]]:
    """(line, left part, mark, right part) where a line ends inside a word or compound."""
    out = []
    for i in range(len(lines) - 1):
        end = lines[i].rstrip()
        if not end or end[-1] not in MARKS:
            continue
        m = _END.search(end, max(end.rfind(" "), end.rfind("\t")) + 1)
        if m and (n := _NEXT.match(lines[i + 1])):
            out.append((i, m["left"], m["mark"], n["right"]))
    return out


def analysed(df: DataFrame, key: str = "page_id", text: str = "text", source: str = "source_rel", page: str = "page_num", method: str = "method") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(pages, furniture, broken words with `joined` or not, misread words with their `right` form).

    The texts are read twice: once for edge lines and the vocabulary, once for the words that the vocabulary judges.
    """
    file = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # never null: joins drop null keys
    pages = df.select(F.col(key).alias("page"), file.alias("file"), F.coalesce(F.col(page), F.lit(0)).cast("int").alias("page_num"), F.col(method).cast("string").alias("method"), F.col(text).alias("text"))
    first = cut(first_pass(pages), "first")
    size = pages.groupBy("file").agg(F.countDistinct("page_num").alias("pages"))
    edges = cut(furniture(first.where("kind = 'edge'"), size), "furniture")
    words = cut(first.where("kind = 'word'").groupBy("word", "shape").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean")), "vocabulary")
    best = words.where(~F.col("word").contains("-") & F.col("word").rlike(r"^\p{L}+$")).groupBy("shape").agg(F.max_by("word", F.struct("clean", "n", "word")).alias("right"), F.max("clean").alias("right_clean"), F.max("n").alias("right_n"))
    odd = F.col("word").rlike(r"[^\p{L}\p{M}]")
    long = F.when(odd, F.length("word") >= 2).otherwise(F.length("word") >= 4)
    wrong = words.where(~F.col("word").contains("-")).join(best, "shape").where((F.col("word") != F.col("right")) & long & (F.length("right") >= 3) & (F.col("right_clean") >= KNOWN) & (F.col("clean") * RARER < F.col("right_clean")))
    wrong = cut(wrong.select("word", "right"), "wrong")
    # a bounded set of words that are surely right keeps most tokens from being looked up at all
    common = {r[0] for r in words.where("clean >= 3").join(wrong, "word", "left_anti").orderBy(F.desc("clean"), "word").limit(COMMON).select("word").collect()}
    usual = df.sparkSession.sparkContext.broadcast(common)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = usual.value
        for batch in (part for whole in batches for part in slices(whole, "text")):
            out = []
            for p, t in zip(batch["page"], batch["text"]):
                if not t:
                    continue
                lines = t.split("\n")
                broken = _broken(lines) if _CUT.search(t) else []
                for i, left, mark, right in broken:
                    l, r = left.lower(), right.lower()
                    tail = l.rpartition("-")[2]
                    out.append((p, "broken", i, tail + r, f"{l}-{r}", tail, r, mark))
                rare = {w for w in set(whole_words(t, lines, broken)) - known if "-" not in w and _is_word(w)}
                if rare:  # where a word stands in the lines between the edges, those decide; else the edge line
                    edge = {i for i, _, _ in edge_places(lines)}
                    inner = rare.intersection(_TOKEN.findall("\n".join(x for i, x in enumerate(lines) if i not in edge).lower()))
                    rows = [(-1, w) for w in inner]
                    if rest := rare - inner:
                        rows += [(i, w) for i in edge for w in rest.intersection(_TOKEN.findall(lines[i].lower()))]
                    out += [(p, "word", i, w, None, None, None, "number" if _NUMBER.fullmatch(w.replace("o", "O").replace("s", "S").replace("i", "I")) else None) for i, w in rows]
            yield pd.DataFrame(out, columns=["page", "kind", "line", "word", "compound", "left", "right_part", "mark"])

    kind = pages.schema["page"].dataType.simpleString()
    rows = pages.select("page", "text").mapInPandas(look, f"page {kind}, kind string, line int, word string, compound string, left string, right_part string, mark string")
    # neither words of running lines nor words cut before or after one count
    gone = edges.select("page", F.col("line_no").alias("line")).distinct()
    gone = gone.withColumn("kind", F.lit("word")).unionByName(gone.select("page", F.explode(F.array(F.col("line") - 1, F.col("line"))).alias("line"), F.lit("broken").alias("kind")).distinct())
    seen = cut(rows.join(gone, ["page", "line", "kind"], "left_anti"), "seen")

    @F.pandas_udf("string")
    def shapes(w: pd.Series) -> pd.Series:
        return w.map(shape)

    broken = seen.where("kind = 'broken'").withColumn("shape", shapes("word"))
    plain = words.where(~F.col("word").contains("-")).select("word", "n")
    compounds = words.where(F.col("word").contains("-")).select(F.col("word").alias("compound"), F.col("n").alias("n_compound"))
    whole = best.select("shape", F.col("right").alias("right_whole"), F.col("right_n").alias("n_whole"))
    judged = (
        broken.join(whole, "shape", "left")
        .join(compounds, "compound", "left")
        .join(plain.select(F.col("word").alias("left"), F.col("n").alias("n_left")), "left", "left")
        .join(plain.select(F.col("word").alias("right_part"), F.col("n").alias("n_right")), "right_part", "left")
        .join(plain.withColumnRenamed("n", "n_word"), "word", "left")
        .fillna(0, ["n_whole", "n_compound", "n_left", "n_right", "n_word"])
    )
    soft = F.col("mark").isin("\u00ad", "¬", "–", "=", "~")
    own = (F.col("n_compound") > 0) & (F.col("n_compound") >= 0.1 * F.col("n_whole"))
    parts = (F.col("n_whole") == 0) & (F.col("n_left") >= KNOWN) & (F.col("n_right") >= KNOWN)
    judged = judged.select("page", "line", "word", "right_whole", "n_word", "n_whole", (soft | ~(own | parts)).alias("joined"))
    # figures among letters are judged by the whole vocabulary, so that what is looked up does not decide
    told = seen.where("kind = 'word'")
    figures = told.where("mark = 'number'").join(wrong, "word", "left_anti").join(words.where("clean < 3"), "word", "left_semi")
    misread = told.join(wrong, "word").select("page", "word", "right").unionByName(figures.select("page", "word", F.lit(None).cast("string").alias("right")))
    known = wrong.select("word", F.col("right").alias("known"))
    unknown = (F.col("n_word") == 0) & (F.col("n_whole") >= KNOWN) & (F.col("word") != F.col("right_whole"))
    torn = judged.where("joined").join(known, "word", "left").where(F.col("known").isNotNull() | unknown).select("page", "word", F.coalesce("known", "right_whole").alias("right"))
    return pages, edges, judged, misread.unionByName(torn)


def noise(df: DataFrame, **columns: str) -> DataFrame:
    """(page_id, kind): one row for each kind of noise that a page holds.

    kind is split_word, running_line, page_number or misread. Null and empty texts hold none, a null file is a file of
    its own, pages delivered twice count once for their file's running lines and each get their rows.
    """
    _, edges, broken, misread = analysed(df, **columns)
    return (
        edges.select("page", "kind")
        .unionByName(broken.where("joined").select("page", F.lit("split_word").alias("kind")))
        .unionByName(misread.select("page", F.lit("misread").alias("kind")))
        .distinct()
        .withColumnRenamed("page", columns.get("key", "page_id"))
    )


def readable(df: DataFrame, **columns: str) -> DataFrame:
    """(page_id, text): continuous paragraphs without running lines, page numbers, cut or misread words.

    Only pages with noise are rewritten; the others, and null or empty texts, stay as they are.
    """
    pages, edges, broken, misread = analysed(df, **columns)
    pages = pages.join(edges.groupBy("page").agg(F.collect_set("line_no").alias("skip")), "page", "left")
    joins = broken.groupBy("page").agg(F.collect_set(F.struct("line", "joined")).alias("breaks"))
    fixes = misread.groupBy("page").agg(F.collect_set(F.struct("word", "right")).alias("fixes"))
    held = edges.select("page").unionByName(broken.where("joined").select("page")).unionByName(misread.select("page")).distinct().withColumn("noisy", F.lit(True))

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, skips: pd.Series, breaks: pd.Series, fixes: pd.Series) -> pd.Series:
        out = []
        for t, s, b, f in zip(texts, skips, breaks, fixes):
            if not t:
                out.append(t)
                continue
            join = {x["line"]: x["joined"] for x in b} if b is not None else {}
            right = {x["word"]: x["right"] for x in f} if f is not None else {}
            out.append(_paragraphs(_body(t, set(s) if s is not None else set()), join, right))
        return pd.Series(out)

    whole = pages.join(held, "page", "left").join(joins, "page", "left").join(fixes, "page", "left")
    text = F.when(F.col("noisy"), rewrite("text", "skip", "breaks", "fixes")).otherwise(F.col("text"))
    return whole.select(F.col("page").alias(columns.get("key", "page_id")), text.alias("text"))


def _paragraphs(lines: list[tuple[int, str]], joined: dict[int, bool], right: dict[str, str | None]) -> str:
    width = max((len(x) for _, x in lines), default=0)
    out, current, above = [], "", (-1, "")
    for i, line in lines:
        if not line.strip():
            out.append(current)
            current = ""
        elif not current:
            current = line.strip()
        elif joined.get(above[0]) is True:
            current = re.sub(r"[-\u2010\u00ad¬–=~]$", "", current) + line.strip()
        elif joined.get(above[0]) is False:
            current += line.strip()
        elif len(above[1].rstrip()) < 0.6 * width and current[-1] in ".?!":  # a short last line ends a paragraph
            out.append(current)
            current = line.strip()
        else:
            current += " " + line.strip()
        above = (i, line)
    text = "\n\n".join(x for x in [*out, current] if x)

    def put(m: re.Match) -> str:
        w = m[0]
        if w.lower() not in right:
            return w
        new = right[w.lower()]
        if new is None:
            return w.translate(FIGURES)
        return new.upper() if len(w) > 1 and w.isupper() else new.capitalize() if w[0].isupper() else new

    return _TOKEN.sub(put, text) if right else text
