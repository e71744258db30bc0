"""From pages with spans and tables to chunks: lines, body size, headings, sections, pieces."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby, islice
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.packing import MAX_CHARS, pack, pack_sentences, section_pieces, table_pieces

MIN_HEADINGS, MIN_TEXT, MIN_TABLE, MAX_CELL = 2, 20, 10, 400
SPAN_SIZE, BOLD_SIZE, MAX_HEADING = 1.15, 1.05, 120


def document_lines(pages: DataFrame, document: str = "source_rel") -> DataFrame:
    """(document, page, pos, text, size, bold): a page's spans where it has any, else the lines of its text."""
    spans = F.transform("spans", lambda s: F.struct(X.strip(s["text"]).alias("text"), s["size"].alias("size"), F.coalesce(s["bold"], F.lit(False)).alias("bold")))
    plain = F.transform(X.lines(F.coalesce("text", F.lit(""))), lambda t: F.struct(t.alias("text"), F.lit(None).cast("double").alias("size"), F.lit(False).alias("bold")))
    chosen = F.when(F.size("spans") > 0, spans).otherwise(plain)
    rows = pages.select(document, F.col("page_num").alias("page"), F.posexplode(chosen).alias("pos", "line"))
    return rows.select(document, "page", "pos", "line.*").where("text <> ''")


def body_size(lines: DataFrame, document: str, order: list[str]) -> DataFrame:
    """(document, body_size): the most frequent rounded size (half to even), the first seen where several are."""
    sized = lines.where("size IS NOT NULL AND size <> 0").select(document, F.bround("size", 0).alias("_size"), F.struct(*order).alias("_at"))
    counts = sized.groupBy(document, "_size").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    ranked = counts.withColumn("_rank", F.row_number().over(Window.partitionBy(document).orderBy(F.desc("_n"), "_first")))
    return ranked.where("_rank = 1").select(document, F.col("_size").alias("body_size"))


def is_heading(text: Column, size: Column, bold: Column, body: Column) -> Column:
    letters = text.rlike("[A-Za-z]{3,}") & ~text.rlike(r"^[\d\.\s\-–—]+$")
    large = (size >= body * SPAN_SIZE) | (bold & (size >= body * BOLD_SIZE))
    return F.coalesce(body.isNotNull() & size.isNotNull() & (F.length(text) > 0) & (F.length(text) <= MAX_HEADING) & letters & large, F.lit(False))


def sections(lines: DataFrame, document: str, order: list[str]) -> DataFrame:
    """(document, section_id, heading, page_start, page_end, text_lines, running_heading) out of lines with `heading`.

    A section runs from a heading to the next; leading lines form section 0. Its heading does not belong to its lines.
    """
    place = Window.partitionBy(document).orderBy(*order)
    numbered = lines.withColumn("section_id", F.sum(F.col("is_heading").cast("int")).over(place.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct(*order)
    grouped = numbered.groupBy(document, "section_id").agg(
        F.max(F.when(F.col("is_heading"), F.col("text"))).alias("heading"), F.min_by("page", at).alias("page_start"), F.max_by("page", at).alias("page_end"),
        F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_heading"), F.struct(at.alias("at"), "text")))), lambda s: s["text"]).alias("text_lines"),
    )
    running = Window.partitionBy(document).orderBy("section_id").rowsBetween(Window.unboundedPreceding, 0)
    return grouped.withColumn("running_heading", F.last("heading", ignorenulls=True).over(running))


def heading_of_page(found: DataFrame, document: str) -> DataFrame:
    """(document, page, heading): the running heading of the first section that covers a page."""
    covered = found.where("page_start IS NOT NULL AND page_end >= page_start").select(document, "section_id", "running_heading", F.explode(F.sequence("page_start", "page_end")).alias("page"))
    return covered.groupBy(document, "page").agg(F.min_by("running_heading", "section_id").alias("heading"))


def plausible_table(table: Column) -> Column:
    """At least two rows, two cells in the first, and no cell above MAX_CELL characters."""
    return F.coalesce((F.size(table) >= 2) & (F.size(F.get(table, F.lit(0))) >= 2) & ~F.exists(F.flatten(table), lambda c: F.length(F.coalesce(c, F.lit(""))) > MAX_CELL), F.lit(False))


def row_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: X.strip(F.coalesce(c, F.lit("")))), " | ")


def _chunk_stream(cap: int):
    """Lines in order -> chunks and the headings of pages with tables, one line after the other.

    Only the open piece is held, or a section's pieces until its last page is known; so a document of any size streams
    through. A row with a null text stands for a page with tables, before the page's lines.
    """

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for document, own in groupby(rows, itemgetter(0)):
            first = next(own)
            own, number = chain([first], own), 0
            if not first[4]:  # no sections: the whole document, its lines as paragraphs
                for piece in pack((r[2] for r in own if r[2] is not None), "\n", cap, lambda p: pack_sentences(p, cap)):
                    if len(piece.strip()) >= MIN_TEXT:
                        yield document, number, None, first[5], first[6], piece
                        number += 1
                continue
            section, heading, span, waiting, headed = 0, None, [None, None], [], []

            def numbered(own=own):
                nonlocal section
                for r in own:
                    section += bool(r[3])
                    yield section, r

            def texts(part):
                nonlocal heading
                for _, (_, page, text, is_heading, *_) in part:
                    if text is None:
                        waiting.append(page)
                        continue
                    if is_heading:
                        heading, span[:] = text, [None, None]
                    # a page with tables lies in the first section that holds a line of it, else in one that runs over it
                    headed.extend((p, heading) for p in waiting if p == page or (span[0] is not None and span[0] <= p))
                    waiting.clear()
                    span[:] = [page if span[0] is None else span[0], page]
                    if not is_heading:
                        yield text

            for _, part in groupby(numbered(), itemgetter(0)):
                pieces = list(section_pieces(texts(part), cap))
                yield from ((document, None, h, p, p, None) for p, h in headed if h is not None)
                headed.clear()
                for piece in pieces:
                    if len(piece.strip()) >= MIN_TEXT:
                        yield document, number, heading, span[0], span[1], piece
                        number += 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for batch in batches for r in batch.itertuples(index=False, name=None))
        found = cut(rows)
        while out := list(islice(found, 2_000)):
            yield pd.DataFrame(out, columns=["document", "number", "heading", "page_start", "page_end", "text"]).astype({c: "Int64" for c in ("number", "page_start", "page_end")})

    return run


def chunk_documents(pages: DataFrame, document: str = "source_rel", cap: int = MAX_CHARS) -> DataFrame:
    """Chunks of documents given as pages (document, doc_type, page_num, text, spans, tables).

    With two headings or more each section is cut by itself, its lines joined by line ends; otherwise the whole document
    is, its lines joined as paragraphs. Tables become chunks of their own under the heading of their page, which only
    documents with sections have. Ids count the chunks that came out: `document::text::n` and
    `document::table::page::table::part`. A page's number is unique in its document; a null document gives no chunks.

    What is known of a document as a whole (body size, number of headings, first and last page) is aggregated first;
    then its lines are sorted and pass through a task as a stream.
    """
    pages = pages.where(F.col(document).isNotNull())
    order = ["page", "pos"]
    lines = document_lines(pages, document)
    sized = lines.join(body_size(lines, document, order), document, "left")
    marked = sized.withColumn("is_heading", is_heading(F.col("text"), F.col("size"), F.col("bold"), F.col("body_size")))
    known = marked.groupBy(document).agg((F.count_if("is_heading") >= MIN_HEADINGS).alias("_sections"), F.min("page").alias("_first"), F.max("page").alias("_last"))
    tables = pages.select(document, "page_num", F.posexplode("tables").alias("_table", "_cells")).where(plausible_table(F.col("_cells")))
    marks = tables.select(document, F.col("page_num").alias("page")).distinct().select(document, "page", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_heading"))
    stream = marked.select(document, *order, "text", "is_heading").unionByName(marks).join(known, document)
    ordered = stream.repartition(document).sortWithinPartitions(document, *order)
    cut = ordered.select(F.col(document).alias("document"), "page", "text", "is_heading", "_sections", "_first", "_last").mapInPandas(
        _chunk_stream(cap), "document string, number long, heading string, page_start int, page_end int, text string"
    )
    kinds = pages.groupBy(F.col(document).alias("document")).agg(F.max("doc_type").alias("doc_type"))
    texts = cut.where("text IS NOT NULL").withColumn("chunk_id", F.format_string("%s::text::%d", "document", "number")).withColumn("chunk_type", F.lit("text"))

    packed = tables.withColumn("_rows", F.transform("_cells", row_text)).select(F.col(document).alias("document"), F.col("page_num").alias("page_start"), "_table", F.posexplode(table_pieces(F.col("_rows"), cap)).alias("_part", "text"))
    headings = cut.where("text IS NULL").select("document", "page_start", "heading")
    headed = packed.where(F.length(X.strip(F.col("text"))) >= MIN_TABLE).join(headings, ["document", "page_start"], "left")
    table_chunks = headed.select(
        "document", "heading", "page_start", F.col("page_start").alias("page_end"), "text",
        F.format_string("%s::table::%d::%d::%d", "document", "page_start", "_table", "_part").alias("chunk_id"), F.lit("table").alias("chunk_type"),
    )
    names = ["document", "chunk_id", "chunk_type", "heading", "page_start", "page_end", "text"]
    both = texts.select(names).unionByName(table_chunks.select(names))
    return both.join(kinds, "document", "left").select(
        "chunk_id", F.col("document").alias("source_file"), "doc_type", "chunk_type", "heading", "page_start", "page_end", "text", F.length("text").alias("char_count")
    )


def docx_lines(pages: DataFrame, drop_body: bool = False) -> DataFrame:
    """Pages of word documents; with `drop_body` a page that has heading spans loses its body text, otherwise it stays."""
    return pages if drop_body else pages.withColumn("spans", F.when(F.col("doc_type") == "docx", F.array().cast(pages.schema["spans"].dataType)).otherwise(F.col("spans")))
