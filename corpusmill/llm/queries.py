"""The queries of the numbered problems, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import boilerplate, canonical, encoding, languages, leakage, mixing, scans, splitting
from .lookalike import TABLE


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that come out of the splitter in more than one piece."""
    return splitting.split_oversized(table(spark, d, "chunks")).where("n_pieces > 1").select("chunk_seq").distinct()


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "chunks")).select("chunk_seq", "piece_no", "heading", "text", "char_count", "overlap_chars")


def p1_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Every text put together again out of its pieces without their overlaps, and whether the pieces keep the limit."""
    found = splitting.split_oversized(table(spark, d, "chunks"))
    part = F.struct("piece_no", F.col("text").substr(F.col("overlap_chars") + 1, F.length("text")).alias("new"))
    whole = found.groupBy("chunk_seq").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.bool_and(F.coalesce((F.length("text") <= splitting.LIMIT) & (F.col("char_count") == F.length("text")) & (F.col("overlap_chars") <= splitting.OVERLAP), F.lit(True))).alias("within"))
    return whole.select("chunk_seq", F.when(F.col("parts")[0]["new"].isNotNull(), F.md5(F.array_join(F.transform("parts", lambda p: p["new"]), ""))).alias("text_md5"), "within")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(table(spark, d, "page_extracts"))


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return encoding.repaired(table(spark, d, "page_extracts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.alike_pairs(table(spark, d, "chunks"))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return canonical.alike_classes(table(spark, d, "chunks"))


def p3_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_texts(table(spark, d, "chunks"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.repeated_blocks(table(spark, d, "chunks")).select("chunk_seq", "line_no").distinct()


def p4_without(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.without_repeated(table(spark, d, "chunks"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noise(table(spark, d, "page_extracts"))


def p5_readable(spark: SparkSession, d: str) -> DataFrame:
    return scans.readable(table(spark, d, "page_extracts"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.mislabelled(table(spark, d, "documents"), table(spark, d, "lang_codes"))


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    found = languages.segments(documents, languages.train(documents, table(spark, d, "lang_codes")))
    return found.select("doc_id", F.explode("segments").alias("s")).select("doc_id", "s.segment_no", "s.lang", F.round("s.confidence", 4).alias("confidence"), "s.n_sentences", "s.n_words")


def p8_languages(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    found = languages.languages(languages.segments(documents, languages.train(documents, table(spark, d, "lang_codes"))))
    return found.select("doc_id", "lang", F.round("confidence", 4).alias("confidence"), "n_sentences", "n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_pieces, p1_rejoined, p2_found, p2_repaired, p3_found, p3_classes, p3_canonical, p4_found, p4_without, p5_found, p5_readable, p6_found, p7_mixture, p7_shares, p8_found, p8_segments, p8_languages)
}

_PATH = r"regexp_replace(regexp_replace(trim(source_file), '[\\/]+', '/', 'g'), '^(\./|/)+', '')"
_ONE = {k: v for k, v in TABLE.items() if v is not None and len(v) == 1}
_FROM = "".join(map(chr, _ONE)) + "".join(chr(k) for k, v in TABLE.items() if v is None)
_TO = "".join(_ONE.values())


def _look(text: str) -> str:
    """SQL for the form in which equal means looking the same."""
    for k, v in TABLE.items():
        if v is not None and len(v) > 1:
            text = f"replace({text}, '{chr(k)}', '{v}')"
    quoted = [x.replace("'", "''") for x in (_FROM, _TO)]
    once = f"translate({text}, '{quoted[0]}', '{quoted[1]}')"
    return f"translate(nfc_normalize({once}), '{quoted[0]}', '{quoted[1]}')"


_LOOKS = f"""c AS (SELECT chunk_seq, coalesce(heading, '') || chr(1) || coalesce(text, '') AS raw FROM chunks), l AS (SELECT chunk_seq, raw, {_look('raw')} AS look FROM c)"""
_LISTED = f"""
f AS (SELECT chunk_seq, {_PATH} AS file, string_split(text, chr(10)) AS x FROM chunks), n AS (SELECT *, regexp_extract(file, '^[^/]*') AS site FROM f),
lines AS (SELECT chunk_seq, site, file, unnest(x) AS line, generate_subscripts(x, 1) AS line_no FROM n),
w AS (SELECT chunk_seq, site, file, line, line_no::INTEGER AS line_no, regexp_replace(lower({_look('line')}), '[^\\p{{L}}\\p{{M}}]', '', 'g') AS wording FROM lines),
sizes AS (SELECT site, count(DISTINCT file) AS files FROM n GROUP BY site),
often AS (SELECT site, wording FROM w JOIN sizes USING (site) WHERE wording <> '' GROUP BY site, wording, files HAVING count(DISTINCT file) >= greatest(4, ceil(files * 0.1 - 1e-9)))"""

ORACLES: dict[str, str] = {
    "p1_found": "SELECT DISTINCT chunk_seq FROM chunks WHERE length(text) > 1600",
    "p1_rejoined": "SELECT chunk_seq, md5(text) AS text_md5, true AS within FROM chunks",
    "p3_found": f"WITH {_LOOKS} SELECT a.chunk_seq AS chunk_seq_a, b.chunk_seq AS chunk_seq_b FROM l a JOIN l b USING (look) WHERE a.chunk_seq < b.chunk_seq AND a.raw <> b.raw",
    "p3_classes": f"""
WITH {_LOOKS}, more AS (SELECT look FROM l GROUP BY look HAVING count(DISTINCT raw) > 1)
SELECT chunk_seq, min(chunk_seq) OVER (PARTITION BY look) AS class_id, min(chunk_seq) OVER (PARTITION BY look, raw) AS writing_id FROM l SEMI JOIN more USING (look)""",
    "p4_found": f"WITH {_LISTED} SELECT DISTINCT chunk_seq, line_no FROM w SEMI JOIN often USING (site, wording)",
    "p4_without": f"""
WITH {_LISTED}, gone AS (SELECT chunk_seq, line_no FROM w SEMI JOIN often USING (site, wording)),
kept AS (SELECT chunk_seq, string_agg(line, chr(10) ORDER BY line_no) AS text FROM w ANTI JOIN gone USING (chunk_seq, line_no) GROUP BY chunk_seq),
n_gone AS (SELECT chunk_seq, count(*)::INTEGER AS removed FROM gone GROUP BY chunk_seq)
SELECT c.chunk_seq, CASE WHEN g.removed IS NULL THEN c.text ELSE coalesce(k.text, '') END AS text, coalesce(g.removed, 0)::INTEGER AS removed
FROM chunks c LEFT JOIN n_gone g USING (chunk_seq) LEFT JOIN kept k USING (chunk_seq)""",
}
