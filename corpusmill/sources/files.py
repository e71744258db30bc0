"""Files of a corpus as tables: listings, HTML, word documents, archives, and adapters for what needs a library."""

from __future__ import annotations

import io
import re
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import suffix
from ..operators.chunking import plausible_table

SUPPORTED = (".pdf", ".htm", ".html", ".docx")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, rel, ext, length) of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    plain = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "%20", " ")
    rel = F.when(F.startswith(plain, F.lit(root.rstrip("/") + "/")), F.substr(plain, F.lit(len(root.rstrip("/")) + 2))).otherwise(plain)
    return files.select("path", rel.alias("rel"), suffix(plain).alias("ext"), "length")


def supported(files: DataFrame) -> DataFrame:
    return files.where(F.col("ext").isin(*SUPPORTED))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.quiet = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.quiet += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.quiet -= tag in ("script", "style") and self.quiet > 0

    def handle_data(self, data: str) -> None:
        if not self.quiet:
            self.parts.append(data)


def html_text(markup: str) -> str:
    """Text nodes joined by line ends, scripts and styles left out, three and more line ends made two."""
    parser = _Text()
    parser.feed(markup)
    parser.close()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(parser.parts)).strip()


def _html(content: bytes) -> list[tuple]:
    return [(0, html_text(content.decode("utf-8", "replace")), "bs4", [], [])]


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx(content: bytes) -> list[tuple]:
    """Paragraphs that are not blank; those styled as headings or titles are spans too."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    paragraphs, spans = [], []
    for p in root.iter(f"{_W}p"):
        text = "".join(t.text or "" for t in p.iter(f"{_W}t"))
        style = p.find(f"{_W}pPr/{_W}pStyle")
        name = (style.get(f"{_W}val") or "" if style is not None else "").lower()
        if text.strip():
            paragraphs.append(text)
            if name.startswith(("heading", "title")):
                spans.append({"text": text.strip(), "size": 16.0, "bold": True, "bbox": None})
    return [(0, "\n".join(paragraphs), "python-docx", spans, [])]


#: Content -> rows (page_num, text, method, spans, tables), or (page_num, exception) for a page that cannot be read. A PDF
#: reader is passed in where a library for it is there.
Reader = Callable[[bytes], Iterable[tuple]]
READERS: dict[str, Reader] = {".htm": _html, ".html": _html, ".docx": _docx}


def pages(spark: SparkSession, root: str, readers: dict[str, Reader] | None = None, tasks: int | None = None, max_pages: int | None = None, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pages, errors) of every supported file below a folder; with `every` other files are rows of errors.

    A file that cannot be read, or has no reader, gives a row of errors and no pages; a page that cannot be read gives a
    row of errors with its number, and the others stay. Pages beyond `max_pages` are left out. Tables that are not
    plausible are dropped. Small files are spread over `tasks` tasks, as a scan packs many of them into one.
    """
    readers = READERS | (readers or {})
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    plain = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "%20", " ")
    rows = found.select(F.substr(plain, F.lit(len(root.rstrip("/")) + 2)).alias("source_rel"), suffix(plain).alias("ext"), "content")
    rows = rows if every else rows.where(F.col("ext").isin(*SUPPORTED))
    if tasks:
        rows = rows.repartition(tasks)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rel, ext, content in zip(batch["source_rel"], batch["ext"], batch["content"]):
                try:
                    if ext not in readers:
                        raise ValueError(f"unsupported extension {ext}")
                    kind = "html" if ext.startswith(".htm") else ext[1:]
                    for number, *page in readers[ext](bytes(content)):
                        if max_pages is not None and number > max_pages:
                            break
                        if len(page) == 1:
                            out.append((rel, kind, number, None, None, None, None, f"page {number} failed: {type(page[0]).__name__}: {page[0]}"))
                        else:
                            out.append((rel, kind, number, *page, None))
                except Exception as e:  # noqa: BLE001  a broken file is a row, not the end of the job
                    out.append((rel, ext[1:], None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_rel", "doc_type", "page_num", "text", "method", "spans", "tables", "error"])

    everything = rows.mapInPandas(read, schemas.PAGES + ", error string").withColumn("tables", F.filter("tables", plausible_table))
    return everything.where("error IS NULL").drop("error"), everything.where("error IS NOT NULL").select("source_rel", "doc_type", "page_num", "error")


def page_counts(pages: DataFrame, file: str = "source_rel", page: str = "page_num") -> DataFrame:
    """(file, n_pages): how many different pages each file has."""
    return pages.groupBy(file).agg(F.countDistinct(page).alias("n_pages"))


def spans_of(raw: DataFrame) -> DataFrame:
    """Spans out of a reader's blocks (type, lines of parts with text, size, flags): text blocks only, size and bold of a
    line's first part, blank lines dropped."""
    lines = F.flatten(F.transform(F.filter("blocks", lambda b: b["type"] == 0), lambda b: b["lines"]))
    spans = F.transform(lines, lambda l: F.struct(F.trim(F.array_join(F.transform(l["parts"], lambda p: p["text"]), "")).alias("text"), F.bround(F.get(l["parts"], F.lit(0))["size"], 1).alias("size"), (F.get(l["parts"], F.lit(0))["flags"].bitwiseAND(16) != 0).alias("bold"), l["bbox"].alias("bbox")))
    return raw.withColumn("spans", F.filter(spans, lambda s: s["text"] != ""))


def archive_census(spark: SparkSession, root: str) -> DataFrame:
    """(archive, ext, files, error): entries of each zip file by extension, folders left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(root).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                        names = [n for n in z.namelist() if not n.endswith("/")]
                    counts = Counter(("." + n.rpartition("/")[2].rpartition(".")[2].lower()) if "." in n.rpartition("/")[2] else "(no ext)" for n in names)
                    out += [(path, ext, n, None) for ext, n in counts.items()]
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["archive", "ext", "files", "error"])

    return found.mapInPandas(read, "archive string, ext string, files long, error string")


def extractions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pages, broken): cached extractions, one JSON document a file; documents that do not parse are counted apart."""
    raw = spark.read.schema(schemas.EXTRACTION + ", _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    good = raw.where("_broken IS NULL").select("source_rel", "doc_type", F.inline("pages"))
    return good, raw.where("_broken IS NOT NULL").select("source_rel", "_broken")


def chunk_store(spark: SparkSession, path: str) -> DataFrame:
    """Chunks from JSON lines; blank lines are skipped."""
    return spark.read.schema(schemas.CHUNK).json(path)


def link_table(spark: SparkSession, path: str) -> DataFrame:
    """Links from JSON lines with `/` separators; an empty table where the file is missing."""
    try:
        found = spark.read.schema(schemas.LINK).json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], schemas.LINK)
    return found.withColumns({c: F.translate(c, "\\", "/") for c in ("path", "linked_to")})


def link_map(spark: SparkSession, path: str) -> DataFrame:
    """Links from JSON documents that map each path to its role, linked_to and match_type; `/` separators."""
    ends = "map<string,struct<role:string,linked_to:string,match_type:string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", ends)).alias("path", "l"))
    return rows.select(F.translate("path", "\\", "/").alias("path"), "l.role", F.translate("l.linked_to", "\\", "/").alias("linked_to"), "l.match_type")


def eval_set(spark: SparkSession, path: str) -> DataFrame:
    """Items of an evaluation set kept as one JSON document."""
    return spark.read.option("multiLine", "true").schema(f"items array<struct<{','.join(':'.join(x.split(' ', 1)) for x in schemas.EVAL_ITEM.split(', '))}>>").json(path).selectExpr("inline(items)")
