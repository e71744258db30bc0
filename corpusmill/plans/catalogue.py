"""Registered queries of the core and the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.packing import pieces, table_pieces
from ..functions.paths import clean_path, site_of
from ..operators import chunking, context, dedup, embedding, generation, incremental, linking, quality, retrieval, survey
from ..sources.tables import table
from ..streaming.ingest import hourly_status

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WHITE = X.WHITE
STRIP = f"regexp_replace(%s, '^[{WHITE}]+|[{WHITE}]+$', '', 'g')"
CLEAN = r"regexp_replace(regexp_replace(trim({0}), '[\\/]+', '/', 'g'), '^(\./|/)+', '')"
TOKENS = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda t: t <> '')"
ROLE_WORDS = ", ".join(f"'{w}'" for w in (*X.QUESTION_WORDS, *X.ANSWER_WORDS))
ANSWERS = ", ".join(f"'{w}'" for w in X.ANSWER_WORDS)
QUESTIONS = ", ".join(f"'{w}'" for w in X.QUESTION_WORDS)
SIGNATURE = f"array_to_string(list_filter({TOKENS}, lambda t: NOT list_contains([{ROLE_WORDS}], t)), ' ')"
ROLE = f"CASE WHEN list_has_any({TOKENS}, [{ANSWERS}]) THEN 'answer' WHEN list_has_any({TOKENS}, [{QUESTIONS}]) THEN 'question' ELSE 'unmarked' END"
BASE = "regexp_replace({0}, '^.*/', '')"
STEM = rf"regexp_replace({BASE}, '(.)\.[^.]*$', '\1')"
PARENT = "CASE WHEN contains({0}, '/') THEN regexp_replace({0}, '/[^/]*$', '') ELSE '' END"
SUFFIX = rf"CASE WHEN lower(regexp_extract({BASE}, '.(\.[^.]+)$', 1)) = '' THEN '(no extension)' ELSE lower(regexp_extract({BASE}, '.(\.[^.]+)$', 1)) END"


def _ratio(text: str, pattern: str) -> str:
    """Part of the characters that match a class, as SQL."""
    return f"((length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g'))) / greatest(length({text}), 1)::DOUBLE)"


def _verdict(text: str, empty: str, name: str) -> str:
    printable, weird, alnum = _ratio(text, r"[^\p{C}\p{Z}]|[ \n\t]"), _ratio(text, r"[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f]"), _ratio(text, r"[\p{L}\p{N}]")
    return f"CASE WHEN {empty} THEN '{name}' WHEN {printable} < 0.85 OR {weird} > 0.02 OR {alnum} < 0.55 THEN 'GARBLED' ELSE 'CLEAN' END"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that has the same result."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


PAGE_VERDICT = f"SELECT page_id, source_rel, page_num, {_verdict('t', 'length(t) < 40', 'EMPTY')} AS verdict FROM (SELECT *, {STRIP % "coalesce(text, '')"} AS t FROM page_extracts)"


# ---- quality -------------------------------------------------------------------------------------------------------
@query(f"SELECT page_id, verdict FROM ({PAGE_VERDICT})")
def page_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.page_quality(table(spark, d, "page_extracts")).select("page_id", "verdict")


FILE_QUALITY = f"""
WITH ranked AS (SELECT source_rel, text, row_number() OVER (PARTITION BY source_rel ORDER BY page_num, page_id) AS r FROM page_extracts),
joined AS (SELECT source_rel, count(*) AS pages_sampled, {STRIP % "string_agg(coalesce(text, ''), '' ORDER BY r)"} AS t FROM ranked WHERE r <= 20 GROUP BY source_rel)
SELECT source_rel, pages_sampled, length(t)::INTEGER AS total_chars, round(length(t) / pages_sampled::DOUBLE, 4) AS avg_chars_per_page,
       CASE WHEN length(t) / pages_sampled::DOUBLE >= 40 THEN round_even({_ratio('t', r'[\p{L}\p{N}]')}, 3) END AS alnum_ratio,
       CASE WHEN length(t) / pages_sampled::DOUBLE >= 40 THEN round_even({_ratio('t', r'[^\p{C}\p{Z}]|[ \n\t]')}, 3) END AS printable_ratio,
       {_verdict('t', 'length(t) / pages_sampled::DOUBLE < 40', 'EMPTY/SCANNED')} AS verdict
FROM joined"""  # fmt: skip


@query(FILE_QUALITY)
def file_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.file_quality(table(spark, d, "page_extracts"), "source_rel", "page_num", "page_id")


@query(f"SELECT verdict, count(*) AS files, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM ({FILE_QUALITY}) GROUP BY verdict")
def verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.verdict_counts(file_quality(spark, d))


@query(f"SELECT page_id, source_rel, (row_number() OVER (PARTITION BY source_rel ORDER BY page_num, page_id))::INTEGER AS ocr_rank, row_number() OVER (PARTITION BY source_rel ORDER BY page_num, page_id) <= 60 AS covered FROM ({PAGE_VERDICT}) WHERE verdict <> 'CLEAN'")
def ocr_budget(spark: SparkSession, d: str) -> DataFrame:
    return quality.ocr_budget(table(spark, d, "page_extracts"), "source_rel", "page_num", "page_id").select("page_id", "source_rel", "ocr_rank", "covered")


@query("SELECT source_rel, array_to_string(list_sort(list_distinct(list(method))), ',') AS methods, count(DISTINCT page_num) AS pages FROM page_extracts GROUP BY source_rel")
def extraction_methods(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_extracts").groupBy("source_rel").agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"), F.countDistinct("page_num").alias("pages"))


# ---- survey --------------------------------------------------------------------------------------------------------
FILES = f"SELECT DISTINCT {CLEAN.format('source_file')} AS path FROM chunks"


def _files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select(clean_path(F.col("source_file")).alias("path")).distinct()


@query(f"SELECT coalesce(ext, 'all') AS ext, count(*) AS files, sum(chars)::BIGINT AS total FROM (SELECT {SUFFIX.format('path')} AS ext, chars FROM (SELECT {CLEAN.format('source_file')} AS path, sum(length(text)) AS chars FROM chunks GROUP BY 1)) GROUP BY ROLLUP (ext)")
def extension_census(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "chunks").groupBy(clean_path(F.col("source_file")).alias("path")).agg(F.sum(F.length("text")).alias("chars"))
    return survey.extension_census(files, "path", "chars")


LATEST = "SELECT path, tries, l.log_id AS log_id, l.status AS status, l.n_pages AS n_pages, l.error AS error, l.elapsed_s AS elapsed_s, l.n_errors::INTEGER AS n_errors FROM (SELECT path, count(*) AS tries, max_by({'log_id': log_id, 'status': status, 'n_pages': n_pages, 'error': error, 'elapsed_s': elapsed_s, 'n_errors': coalesce(len(extract_errors), 0)}, {'at': coalesce(logged_at, TIMESTAMP '1970-01-01'), 'log_id': log_id}) AS l FROM extract_log GROUP BY path)"


@query(LATEST)
def latest_log(spark: SparkSession, d: str) -> DataFrame:
    return survey.latest_log(table(spark, d, "extract_log"))


@query(f"""
SELECT b.bucket_no, b.bucket, count(l.path) AS files, coalesce(sum(l.n_pages), 0)::BIGINT AS pages
FROM (VALUES (0, '0-20', -1, 20), (1, '21-50', 20, 50), (2, '51-100', 50, 100), (3, '101-300', 100, 300), (4, '301-600', 300, 600), (5, '601+', 600, 1 << 30)) b(bucket_no, bucket, low, high)
LEFT JOIN ({LATEST}) l ON l.n_pages > b.low AND l.n_pages <= b.high GROUP BY b.bucket_no, b.bucket""")
def page_histogram(spark: SparkSession, d: str) -> DataFrame:
    return survey.page_histogram(latest_log(spark, d), "n_pages")


@query("SELECT path, n_pages FROM (SELECT DISTINCT path, n_pages FROM extract_log WHERE n_pages IS NOT NULL) ORDER BY n_pages DESC, path DESC LIMIT 25")
def largest_files(spark: SparkSession, d: str) -> DataFrame:
    return survey.largest(table(spark, d, "extract_log").where("n_pages IS NOT NULL").select("path", "n_pages").distinct(), "n_pages", "path")


@query("SELECT doc_id, n_chars FROM documents ORDER BY md5(doc_id::VARCHAR || '|42'), doc_id LIMIT 100")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return survey.seeded_sample(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", 100)


@query("SELECT status, count(*) AS rows, round(coalesce(avg(elapsed_s), 0), 6) AS avg_s, coalesce(sum(len(extract_errors)), 0)::BIGINT AS soft_errors FROM extract_log GROUP BY status")
def job_counters(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "extract_log")
    return log.groupBy("status").agg(F.count("*").alias("rows"), F.round(F.coalesce(F.avg("elapsed_s"), F.lit(0.0)), 6).alias("avg_s"), F.coalesce(F.sum(F.when(F.col("extract_errors").isNotNull(), F.size("extract_errors"))), F.lit(0)).alias("soft_errors"))


@query("SELECT date_trunc('hour', logged_at) AS hour, status, count(*) AS files FROM extract_log WHERE logged_at IS NOT NULL GROUP BY 1, 2")
def hourly_log(spark: SparkSession, d: str) -> DataFrame:
    return hourly_status(table(spark, d, "extract_log").where("logged_at IS NOT NULL"))


# ---- names and links -----------------------------------------------------------------------------------------------
@query(f"SELECT path, {PARENT.format('path')} AS parent, {STEM.format('path')} AS stem, {SUFFIX.format('path')} AS ext, regexp_extract(path, '^[^/]*') AS site, {ROLE.format(STEM.format('path'))} AS role, {SIGNATURE.format(STEM.format('path'))} AS signature FROM ({FILES})")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return _files(spark, d).select("path", X.parent(p).alias("parent"), X.stem(p).alias("stem"), X.suffix(p).alias("ext"), site_of(p).alias("site"), X.role(X.stem(p)).alias("role"), X.signature(X.stem(p)).alias("signature"))


FOLDERS = f"SELECT DISTINCT array_to_string(p[1:n], '/') AS folder FROM (SELECT p, unnest(generate_series(1, len(p))) AS n FROM (SELECT DISTINCT string_split({PARENT.format('path')}, '/') AS p FROM ({FILES})))"
FOLDER_PAIRS = f"""
SELECT a, b, role_a, role_b FROM (
  SELECT min(f) AS a, max(f) AS b, min_by(r, f) AS role_a, max_by(r, f) AS role_b, count(*) AS n
  FROM (SELECT folder AS f, {PARENT.format('folder')} AS above, {SIGNATURE.format(BASE.format('folder'))} AS sig, {ROLE.format(BASE.format('folder'))} AS r
        FROM ({FOLDERS}) WHERE folder <> '') GROUP BY above, sig)
WHERE n = 2 AND role_a <> role_b"""
NAMED = f"SELECT path, {PARENT.format('path')} AS folder, {BASE.format('path')} AS name, {SIGNATURE.format(STEM.format('path'))} AS sig FROM ({FILES})"


def _both(pairs: str, kind: str) -> str:
    one = "CASE WHEN role_a = 'answer' THEN 'answer' ELSE 'question' END"
    two = "CASE WHEN role_a = 'answer' THEN 'question' ELSE 'answer' END"
    return f"SELECT pa AS path, {one} AS role, pb AS linked_to, '{kind}' AS match_type FROM ({pairs}) UNION ALL SELECT pb, {two}, pa, '{kind}' FROM ({pairs})"


LINKS_WITH = f"""
WITH pairs AS ({FOLDER_PAIRS}), named AS ({NAMED}),
l AS (SELECT p.a, p.b, role_a, role_b, path, name, sig FROM pairs p JOIN named ON folder = p.a),
r AS (SELECT p.a, p.b, path, name, sig FROM pairs p JOIN named ON folder = p.b),
exact AS (SELECT l.path AS pa, r.path AS pb, role_a, role_b FROM l JOIN r USING (a, b, name)),
l2 AS (SELECT * FROM l ANTI JOIN r USING (a, b, name)), r2 AS (SELECT * FROM r ANTI JOIN l USING (a, b, name)),
strict AS (SELECT x.p AS pa, y.p AS pb, role_a, role_b FROM
  (SELECT a, b, sig, min(path) AS p, min(role_a) AS role_a, min(role_b) AS role_b FROM l2 WHERE sig <> '' GROUP BY a, b, sig HAVING count(*) = 1) x
  JOIN (SELECT a, b, sig, min(path) AS p FROM r2 WHERE sig <> '' GROUP BY a, b, sig HAVING count(*) = 1) y USING (a, b, sig)),
loose AS (SELECT x.p AS pa, y.p AS pb, role_a, role_b FROM
  (SELECT a, b, replace(sig, ' ', '') AS k, min(path) AS p, min(role_a) AS role_a, min(role_b) AS role_b FROM (SELECT * FROM l2 ANTI JOIN r2 USING (a, b, sig)) WHERE sig <> '' GROUP BY ALL HAVING count(*) = 1) x
  JOIN (SELECT a, b, replace(sig, ' ', '') AS k, min(path) AS p FROM (SELECT * FROM r2 ANTI JOIN l2 USING (a, b, sig)) WHERE sig <> '' GROUP BY ALL HAVING count(*) = 1) y USING (a, b, k)),
folder_links AS ({_both('FROM exact', 'folder_pair+exact_filename')} UNION ALL {_both('FROM strict', 'folder_pair+fuzzy_filename')} UNION ALL {_both('FROM loose', 'folder_pair+fuzzy_filename+loose')}),
sib AS (SELECT min(path) AS pa, max(path) AS pb, min_by(role, path) AS role_a, max_by(role, path) AS role_b
  FROM (SELECT path, folder, sig, {ROLE.format(STEM.format('path'))} AS role FROM named WHERE sig <> '') GROUP BY folder, sig HAVING count(*) = 2),
open_sib AS (SELECT * FROM sib WHERE role_a <> role_b AND pa NOT IN (SELECT path FROM folder_links) AND pb NOT IN (SELECT path FROM folder_links)),
links AS (SELECT * FROM folder_links UNION ALL {_both('FROM open_sib', 'same_folder_filename')})
"""  # fmt: skip


@query(FOLDER_PAIRS)
def folder_pairs(spark: SparkSession, d: str) -> DataFrame:
    return linking.folder_pairs(_files(spark, d))


@query(LINKS_WITH + "SELECT * FROM links")
def file_links(spark: SparkSession, d: str) -> DataFrame:
    return linking.all_links(_files(spark, d))


@query(LINKS_WITH + "SELECT match_type, (count(*) // 2)::BIGINT AS pairs, count(DISTINCT path) AS files FROM links GROUP BY match_type")
def link_stats(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_stats(linking.all_links(_files(spark, d)))


@query(LINKS_WITH + f"SELECT (SELECT count(*) FROM ({FILES})) AS files, count(DISTINCT path) AS linked_files, (count(*) // 2)::BIGINT AS pairs, round(100 * count(DISTINCT path) / (SELECT count(*) FROM ({FILES})), 1) AS linked_pct FROM links")
def link_coverage(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_coverage(_files(spark, d), linking.all_links(_files(spark, d)))


@query(f"SELECT folder, {PARENT.format('folder')} AS above FROM (SELECT folder FROM ({FOLDERS}) UNION SELECT '')")
def folders(spark: SparkSession, d: str) -> DataFrame:
    """Every folder of a file and the folders above it, the root included."""
    return linking.folders_of(_files(spark, d)).select("folder", X.parent(F.col("folder")).alias("above"))


LINK_TABLE = f"SELECT {CLEAN.format('path')} AS path, qa_role AS role, {CLEAN.format('linked_to')} AS linked_to, match_type FROM qa_links"


def _links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_links").select(clean_path(F.col("path")).alias("path"), F.col("qa_role").alias("role"), clean_path(F.col("linked_to")).alias("linked_to"), "match_type")


@query(f"WITH l AS ({LINK_TABLE}) SELECT count(*) AS links, count(DISTINCT path) AS files, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM l b WHERE b.path = l.linked_to AND b.linked_to = l.path)) AS one_way FROM l")
def link_symmetry(spark: SparkSession, d: str) -> DataFrame:
    links = _links(spark, d)
    return links.agg(F.count("*").alias("links"), F.countDistinct("path").alias("files")).crossJoin(linking.asymmetric(links).agg(F.count("*").alias("one_way")))  # one row each


@query(f"WITH found AS ({LINKS_WITH} SELECT DISTINCT path, linked_to FROM links), given AS (SELECT DISTINCT path, linked_to FROM ({LINK_TABLE})) SELECT (SELECT count(*) FROM found) AS found, (SELECT count(*) FROM given) AS given, (SELECT count(*) FROM found SEMI JOIN given USING (path, linked_to)) AS both_have")
def link_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How many of the links that names tell are in the table of links."""
    found, given = linking.all_links(_files(spark, d)).select("path", "linked_to").distinct(), _links(spark, d).select("path", "linked_to").distinct()
    n = lambda x, name: x.agg(F.count("*").alias(name))
    return n(found, "found").crossJoin(n(given, "given")).crossJoin(n(found.join(given, ["path", "linked_to"], "left_semi"), "both_have"))  # one row each


# ---- duplicates and aliases ----------------------------------------------------------------------------------------
WINNERS = f"""
SELECT chunk_seq, path AS source_file, first_value(path) OVER w AS winner, row_number() OVER w = 1 AS survives
FROM (SELECT chunk_seq, {CLEAN.format('source_file')} AS path, text FROM chunks)
WINDOW w AS (PARTITION BY text ORDER BY length(path) - length(replace(path, '/', '')), length(path), path, chunk_seq)"""
ALIASES = f"""
SELECT original_file, winner_file FROM (
  SELECT source_file AS original_file, winner AS winner_file, row_number() OVER (PARTITION BY source_file ORDER BY votes DESC, first) AS r
  FROM (SELECT source_file, winner, count(*) AS votes, min(chunk_seq) AS first FROM ({WINNERS}) GROUP BY source_file, winner)) WHERE r = 1 AND winner_file <> original_file"""
REMAPPED = f"""
SELECT path, role, linked_to, match_type FROM (
  SELECT coalesce(a.winner_file, l.path) AS path, role, coalesce(b.winner_file, l.linked_to) AS linked_to, match_type,
         row_number() OVER (PARTITION BY coalesce(a.winner_file, l.path) ORDER BY l.path DESC, l.linked_to DESC, l.match_type DESC, l.role DESC) AS r
  FROM ({LINK_TABLE}) l LEFT JOIN ({ALIASES}) a ON a.original_file = l.path LEFT JOIN ({ALIASES}) b ON b.original_file = l.linked_to
  WHERE coalesce(a.winner_file, l.path) <> coalesce(b.winner_file, l.linked_to)) WHERE r = 1"""


@query(f"SELECT chunk_seq, source_file FROM ({WINNERS}) WHERE survives")
def dedup_canonical(spark: SparkSession, d: str) -> DataFrame:
    return dedup.survivors(table(spark, d, "chunks"))


@query(ALIASES)
def file_aliases(spark: SparkSession, d: str) -> DataFrame:
    return dedup.aliases(dedup.winners(table(spark, d, "chunks")))


def _remapped(spark: SparkSession, d: str) -> DataFrame:
    """The last of several links of one file is the one that is greatest, as the table has no order of its own."""
    links = _links(spark, d).withColumn("link_no", F.struct(F.col("path").alias("a"), F.col("linked_to").alias("b"), F.col("match_type").alias("c"), F.col("role").alias("d")))
    return dedup.remap_links(links, file_aliases(spark, d))


@query(REMAPPED)
def remapped_links(spark: SparkSession, d: str) -> DataFrame:
    return _remapped(spark, d)


@query(f"SELECT s.chunk_seq, s.source_file, l.role AS qa_role, l.linked_to AS linked_source FROM (SELECT * FROM ({WINNERS}) WHERE survives) s LEFT JOIN ({REMAPPED}) l ON l.path = s.source_file")
def annotated_chunks(spark: SparkSession, d: str) -> DataFrame:
    return dedup.annotate(dedup.survivors(table(spark, d, "chunks")), _remapped(spark, d)).select("chunk_seq", "source_file", "qa_role", "linked_source")


@query(f"""SELECT count(*) FILTER (WHERE survives) AS total_chunks, max(length(text)) FILTER (WHERE survives) AS max_chars, count(linked_to) FILTER (WHERE survives) AS linked_chunks,
count(DISTINCT CASE WHEN linked_to IS NOT NULL AND survives THEN w.source_file END) AS linked_files, count(*) AS raw_chunks, count(*) FILTER (WHERE NOT survives) AS dropped_chunks,
(SELECT count(DISTINCT path) FROM ({LINK_TABLE}) g SEMI JOIN ({ALIASES}) a ON a.original_file = g.path) AS aliased_links
FROM ({WINNERS}) w JOIN chunks c USING (chunk_seq) LEFT JOIN ({REMAPPED}) l ON l.path = w.source_file""")
def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunks")
    return dedup.chunk_stats(dedup.winners(chunks), chunks, _remapped(spark, d), _links(spark, d))


@query("SELECT chunk_type, doc_type, count(*) AS chunks, round(avg(length(text)), 4) AS avg_chars, max(length(text)) AS max_chars FROM chunks GROUP BY ALL")
def chunk_lengths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").groupBy("chunk_type", "doc_type").agg(F.count("*").alias("chunks"), F.round(F.avg(F.length("text")), 4).alias("avg_chars"), F.max(F.length("text")).cast("long").alias("max_chars"))


@query("SELECT chunk_seq, coalesce(heading, '') AS heading, coalesce(page_start, -1) AS page_start, coalesce(page_end, -1) AS page_end, length(text) AS char_count FROM chunks")
def store_metadata(spark: SparkSession, d: str) -> DataFrame:
    """What a store that cannot hold nulls is given."""
    return table(spark, d, "chunks").select("chunk_seq", F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("page_start", F.lit(-1)).alias("page_start"), F.coalesce("page_end", F.lit(-1)).alias("page_end"), F.length("text").cast("long").alias("char_count"))


# ---- chunking ------------------------------------------------------------------------------------------------------
#: Lines of a chunk with a size and weight that follow from their length, as the tables hold no spans.
SPANS = f"""
SELECT chunk_seq AS doc, i AS pos, t AS text, ((length(t) % 7) * 0.5 + 9)::DOUBLE AS size, length(t) % 3 = 0 AS bold, coalesce(page_start, 0) + i // 4 AS page
FROM (SELECT chunk_seq, page_start, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS i FROM (SELECT chunk_seq, page_start, list_filter(list_transform(string_split(text, chr(10)), lambda x: {STRIP % 'x'}), lambda x: x <> '') AS l FROM chunks))"""
BODY = f"SELECT doc, body_size FROM (SELECT doc, s AS body_size, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, min(pos)) AS r FROM (SELECT doc, pos, round_even(size, 0) AS s FROM ({SPANS})) GROUP BY doc, s) WHERE r = 1"
HEADINGS = rf"""
SELECT s.*, length(text) <= 120 AND regexp_matches(text, '[A-Za-z]{{3,}}') AND NOT regexp_matches(text, '^[\d\.\s\-–—]+$') AND (size >= body_size * 1.15::DOUBLE OR (bold AND size >= body_size * 1.05::DOUBLE)) AS is_heading
FROM ({SPANS}) s JOIN ({BODY}) USING (doc)"""
SECTIONS = f"""
SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY doc ORDER BY section_id ROWS UNBOUNDED PRECEDING) AS running_heading FROM (
  SELECT doc, section_id, max(CASE WHEN is_heading THEN text END) AS heading, min_by(page, pos) AS page_start, max_by(page, pos) AS page_end, count(*) FILTER (WHERE NOT is_heading) AS n_lines
  FROM (SELECT *, sum(is_heading::INT) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section_id FROM ({HEADINGS})) GROUP BY doc, section_id)"""


def _spans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select(F.col("chunk_seq").alias("doc"), "page_start", F.posexplode(F.filter(F.transform(F.split("text", "\n"), X.strip), lambda x: x != "")).alias("pos", "text"))
    return rows.select("doc", "pos", "text", ((F.length("text") % 7) * 0.5 + 9).cast("double").alias("size"), (F.length("text") % 3 == 0).alias("bold"), (F.coalesce("page_start", F.lit(0)) + F.floor(F.col("pos") / 4)).cast("int").alias("page"))


def _headed(spark: SparkSession, d: str) -> DataFrame:
    lines = _spans(spark, d)
    sized = lines.join(chunking.body_size(lines, "doc", ["pos"]), "doc")
    return sized.withColumn("is_heading", chunking.is_heading(F.col("text"), F.col("size"), F.col("bold"), F.col("body_size")))


@query(BODY)
def body_font_mode(spark: SparkSession, d: str) -> DataFrame:
    return chunking.body_size(_spans(spark, d), "doc", ["pos"])


@query(f"SELECT doc, section_id::BIGINT AS section_id, heading, page_start::INTEGER AS page_start, page_end::INTEGER AS page_end, n_lines, running_heading FROM ({SECTIONS})")
def sections(spark: SparkSession, d: str) -> DataFrame:
    found = chunking.sections(_headed(spark, d), "doc", ["pos"])
    return found.select("doc", "section_id", "heading", "page_start", "page_end", F.size("text_lines").cast("long").alias("n_lines"), "running_heading")


@query(f"SELECT doc, page, min_by_heading[1] AS heading FROM (SELECT doc, page, list(running_heading ORDER BY section_id) AS min_by_heading FROM (SELECT doc, section_id, running_heading, unnest(generate_series(page_start::BIGINT, page_end::BIGINT)) AS page FROM ({SECTIONS})) GROUP BY doc, page)")
def heading_by_page(spark: SparkSession, d: str) -> DataFrame:
    found = chunking.heading_of_page(chunking.sections(_headed(spark, d), "doc", ["pos"]), "doc")
    return found.select("doc", F.col("page").cast("long").alias("page"), "heading")


def _pack_sql(units: str, joint: str, oversize: Callable[[str], str], v: str, cap: int = 1600) -> str:
    """Greedy packing as SQL: pieces are parted by chr(2), what an oversize unit became ends with chr(3)."""
    coded = f"list_transform({units}, lambda {v}: CASE WHEN length({v}) > {cap} THEN {oversize(v)} || chr(3) ELSE {v} END)"
    a, b = f"x{v}", f"y{v}"
    apart = f"right({b}, 1) = chr(3) OR right({a}, 1) = chr(3) OR length(regexp_extract({a}, '[^\\x02]*$')) + length({b}) + 1 > {cap}"
    return f"coalesce(list_reduce(list_prepend('', {coded}), lambda {a}, {b}: CASE WHEN {a} = '' THEN {b} WHEN {apart} THEN {a} || chr(2) || {b} ELSE {a} || {joint} || {b} END), '')"


def _slices_sql(w: str) -> str:
    return f"array_to_string(list_transform(generate_series(0, (length({w}) - 1) // 1600), lambda i: substring({w}, (i * 1600 + 1)::BIGINT, 1600)), chr(2))"


def _words_sql(t: str) -> str:
    return _pack_sql(f"list_filter(string_split({t}, ' '), lambda f: f <> '')", "' '", _slices_sql, "w")


def _sentences_sql(t: str) -> str:
    return _pack_sql(f"list_filter(string_split(regexp_replace({t}, '([.?!])[{WHITE}]+', '\\1' || chr(1), 'g'), chr(1)), lambda f: f <> '')", "' '", _words_sql, "s")


def _paragraphs_sql(t: str) -> str:
    units = f"list_filter(list_transform(string_split(regexp_replace({t}, '\\n[{WHITE}]*\\n', chr(4), 'g'), chr(4)), lambda f: {STRIP % 'f'}), lambda f: f <> '')"
    return _pack_sql(units, "chr(10)", _sentences_sql, "p")


def _unpacked(rows: str, keys: str) -> str:
    """One row for each piece out of (keys, packed)."""
    return f"SELECT {keys}, (generate_subscripts(x, 1) - 1)::INTEGER AS piece_no, unnest(x) AS text FROM (SELECT {keys}, list_filter(string_split(replace(packed, chr(3), ''), chr(2)), lambda f: f <> '') AS x FROM ({rows}))"


PIECES = _unpacked(f"SELECT doc_id, {_paragraphs_sql('text')} AS packed FROM documents", "doc_id")


@query(f"SELECT *, length(text)::INTEGER AS char_count FROM ({PIECES})")
def packed_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Paragraph and sentence packing under the cap."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(pieces(F.col("text"))).alias("piece_no", "text")).withColumn("char_count", F.length("text"))


CELLS = "SELECT chunk_seq, list_transform(string_split(text, chr(10)), lambda r: string_split(r, ' | ')) AS t FROM chunks WHERE chunk_type = 'table'"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").where("chunk_type = 'table'").select("chunk_seq", F.transform(F.split("text", "\n"), lambda r: F.split(r, r" \| ", -1)).alias("t"))


@query(f"SELECT chunk_seq, len(t) AS n_rows, len(t) >= 2 AND len(t[1]) >= 2 AND len(list_filter(flatten(t), lambda c: length(c) > 400)) = 0 AS plausible FROM ({CELLS})")
def plausible_tables(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select("chunk_seq", F.size("t").cast("long").alias("n_rows"), chunking.plausible_table(F.col("t")).alias("plausible"))


ROW_TEXTS = f"SELECT chunk_seq, list_transform(t, lambda r: array_to_string(list_transform(r, lambda c: {STRIP % 'c'}), ' | ')) AS r FROM ({CELLS}) WHERE len(t) >= 2 AND len(t[1]) >= 2 AND len(list_filter(flatten(t), lambda c: length(c) > 400)) = 0"
PACKED_TABLES = f"""
SELECT chunk_seq, CASE WHEN list_sum(list_transform(r, lambda x: length(x) + 1)) <= 1600 THEN array_to_string(r, chr(10))
  ELSE list_reduce(list_prepend(r[1], r[2:]), lambda a, b: CASE WHEN a <> r[1] AND right(a, length(r[1]) + 1) <> chr(2) || r[1] AND length(regexp_extract(a, '[^\\x02]*$')) + length(b) + 1 > 1600 THEN a || chr(2) || r[1] || chr(10) || b ELSE a || chr(10) || b END) END AS packed
FROM ({ROW_TEXTS})"""


@query(f"SELECT chunk_seq, piece_no AS part, text FROM ({_unpacked(PACKED_TABLES, 'chunk_seq')})")
def table_pieces_packed(spark: SparkSession, d: str) -> DataFrame:
    rows = _cells(spark, d).where(chunking.plausible_table(F.col("t"))).withColumn("rows", F.transform("t", chunking.row_text))
    return rows.select("chunk_seq", F.posexplode(table_pieces(F.col("rows"))).alias("part", "text"))


PAGE_LINES = f"""
SELECT source_rel, doc_type, list(l ORDER BY page_num, pos) AS units, min(page_num) AS page_start, max(page_num) AS page_end FROM (
  SELECT source_rel, doc_type, page_num, unnest(x) AS l, generate_subscripts(x, 1) AS pos FROM (
    SELECT source_rel, max(doc_type) OVER (PARTITION BY source_rel) AS doc_type, page_num, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '{X.LINE_END}', chr(10), 'g'), chr(10)), lambda f: {STRIP % 'f'}), lambda f: f <> '') AS x
    FROM page_extracts QUALIFY row_number() OVER (PARTITION BY source_rel, page_num ORDER BY page_id) = 1)) GROUP BY source_rel, doc_type"""
PAGE_PIECES = _unpacked(f"SELECT source_rel, doc_type, page_start, page_end, {_pack_sql('units', 'chr(10)', _sentences_sql, 'p')} AS packed FROM ({PAGE_LINES})", "source_rel, doc_type, page_start, page_end")


@query(f"""
SELECT source_rel || '::text::' || (row_number() OVER (PARTITION BY source_rel ORDER BY piece_no) - 1)::VARCHAR AS chunk_id, source_rel AS source_file, doc_type, 'text' AS chunk_type, NULL::VARCHAR AS heading,
       page_start, page_end, text, length(text)::INTEGER AS char_count FROM ({PAGE_PIECES}) WHERE length({STRIP % 'text'}) >= 20""")
def chunked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of every extracted file, out of its pages' lines."""
    from .. import schemas

    pages = table(spark, d, "page_extracts")
    one = pages.groupBy("source_rel", "page_num").agg(F.min_by(F.struct("doc_type", "text", "method"), "page_id").alias("p")).select("source_rel", "p.doc_type", "page_num", "p.text", "p.method")
    kinds = spark.createDataFrame([], schemas.PAGES).schema
    return chunking.chunk_documents(one.withColumns({c: F.array().cast(kinds[c].dataType) for c in ("spans", "tables")}))


#: Files as documents: every chunk is a page, text chunks with spans as above, table chunks with a table.
FILE_LINES = f"""
SELECT doc, page, i AS pos, t AS text, ((length(t) % 7) * 0.5 + 9)::DOUBLE AS size, length(t) % 3 = 0 AS bold
FROM (SELECT doc, page, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM (SELECT {CLEAN.format('source_file')} AS doc, chunk_seq AS page, list_filter(list_transform(string_split(text, chr(10)), lambda x: {STRIP % 'x'}), lambda x: x <> '') AS l FROM chunks WHERE chunk_type = 'text'))"""
FILE_CHUNKS = rf"""
WITH line AS MATERIALIZED ({FILE_LINES}),
body AS (SELECT doc, s AS body_size, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, min({{'a': page, 'b': pos}})) AS r FROM (SELECT doc, page, pos, round_even(size, 0) AS s FROM line) GROUP BY doc, s),
head AS MATERIALIZED (SELECT line.*, length(text) <= 120 AND regexp_matches(text, '[A-Za-z]{{3,}}') AND NOT regexp_matches(text, '^[\d\.\s\-–—]+$') AND (size >= body_size * 1.15::DOUBLE OR (bold AND size >= body_size * 1.05::DOUBLE)) AS is_heading
  FROM line JOIN body ON body.doc = line.doc AND r = 1),
known AS (SELECT doc, count(*) FILTER (WHERE is_heading) >= 2 AS in_sections, min(page) AS f, max(page) AS l, list(text ORDER BY page, pos) AS units FROM head GROUP BY doc),
sec AS MATERIALIZED (SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY doc ORDER BY section_id ROWS UNBOUNDED PRECEDING) AS running FROM (
  SELECT doc, section_id, max(CASE WHEN is_heading THEN text END) AS heading, min(page) AS page_start, max(page) AS page_end, string_agg(text, chr(10) ORDER BY page, pos) FILTER (WHERE NOT is_heading) AS txt
  FROM (SELECT *, sum(is_heading::INT) OVER (PARTITION BY doc ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS section_id FROM head SEMI JOIN (SELECT doc FROM known WHERE in_sections) USING (doc)) GROUP BY doc, section_id)),
packed AS (SELECT doc, section_id::BIGINT AS section_id, heading, page_start, page_end, {_paragraphs_sql('txt')} AS packed FROM sec WHERE txt IS NOT NULL
  UNION ALL SELECT doc, 0, NULL, f, l, {_pack_sql('units', 'chr(10)', _sentences_sql, 'p')} FROM known WHERE NOT in_sections),
texts AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY section_id, piece_no) - 1 AS n FROM ({_unpacked('FROM packed', 'doc, section_id, heading, page_start, page_end')}) WHERE length({STRIP % 'text'}) >= 20),
kinds AS (SELECT {CLEAN.format('source_file')} AS doc, max(doc_type) AS doc_type FROM chunks GROUP BY 1),
tables AS (SELECT t.*, {CLEAN.format('c.source_file')} AS doc FROM ({_unpacked(PACKED_TABLES, 'chunk_seq')}) t JOIN chunks c USING (chunk_seq) WHERE length({STRIP % 't.text'}) >= 10),
headed AS (SELECT t.chunk_seq, arg_min_null(s.running, s.section_id) AS heading FROM (SELECT DISTINCT chunk_seq, doc FROM tables) t JOIN sec s ON s.doc = t.doc AND s.page_start <= t.chunk_seq AND s.page_end >= t.chunk_seq GROUP BY t.chunk_seq)
SELECT doc || '::text::' || n::VARCHAR AS chunk_id, doc AS source_file, doc_type, 'text' AS chunk_type, heading, page_start::INTEGER AS page_start, page_end::INTEGER AS page_end, text, length(text)::INTEGER AS char_count FROM texts JOIN kinds USING (doc)
UNION ALL SELECT doc || '::table::' || chunk_seq::VARCHAR || '::0::' || piece_no::VARCHAR, doc, doc_type, 'table', heading, chunk_seq::INTEGER, chunk_seq::INTEGER, text, length(text)::INTEGER FROM tables JOIN kinds USING (doc) LEFT JOIN headed USING (chunk_seq)"""


@query(FILE_CHUNKS)
def chunked_files(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of files with spans and tables: headings, sections, pieces, tables under the heading of their page."""
    from .. import schemas

    is_text = F.col("chunk_type") == "text"
    line = lambda t: F.struct(t.alias("text"), ((F.length(t) % 7) * 0.5 + 9).cast("double").alias("size"), (F.length(t) % 3 == 0).alias("bold"), F.lit(None).cast("array<double>").alias("bbox"))
    lines = F.filter(F.transform(F.split("text", "\n"), X.strip), lambda x: x != "")
    cells = F.transform(F.split("text", "\n"), lambda r: F.split(r, r" \| ", -1))
    kinds = spark.createDataFrame([], schemas.PAGES).schema
    pages = table(spark, d, "chunks").select(
        clean_path(F.col("source_file")).alias("source_rel"), "doc_type", F.col("chunk_seq").cast("int").alias("page_num"), F.lit("").alias("text"), F.lit("table").alias("method"),
        F.when(is_text, F.transform(lines, line)).otherwise(F.array().cast(kinds["spans"].dataType)).alias("spans"),
        F.when(~is_text, F.array(cells)).otherwise(F.array().cast(kinds["tables"].dataType)).alias("tables"),
    )
    return chunking.chunk_documents(pages)


CLEAN_DOCUMENTS = f"SELECT * FROM (SELECT *, {_verdict('t', 'length(t) < 40', 'EMPTY')} AS verdict FROM (SELECT *, {STRIP % "coalesce(text, '')"} AS t FROM documents)) WHERE verdict = 'CLEAN'"
PASSAGES = _unpacked(f"SELECT doc_id, source, {_paragraphs_sql('text')} AS packed FROM ({CLEAN_DOCUMENTS})", "doc_id, source")


@query(f"""
SELECT source, count(*) AS passages, sum(copies)::BIGINT AS raw, round(avg(length(text)), 4) AS avg_chars, max(length(text))::INTEGER AS max_chars
FROM (SELECT text, arg_min_null(source, doc_id) AS source, count(*) AS copies FROM ({PASSAGES}) WHERE length(text) >= 20 GROUP BY text) GROUP BY source""")
def usable_passages(spark: SparkSession, d: str) -> DataFrame:
    """Usable distinct passages of each source and their lengths: quality, packing, exact duplicates, statistics."""
    clean = quality.page_quality(table(spark, d, "documents")).where("verdict = 'CLEAN'")
    passages = clean.select("doc_id", "source", "lang", F.explode(pieces(F.col("text"))).alias("text")).where(F.length("text") >= chunking.MIN_TEXT)
    distinct = passages.groupBy(F.sha1("text").alias("hash")).agg(F.min_by(F.struct("source", "doc_id"), "doc_id").alias("o"), F.max(F.length("text")).alias("size"), F.count("*").alias("copies"))
    return distinct.groupBy(F.col("o.source").alias("source")).agg(F.count("*").alias("passages"), F.sum("copies").alias("raw"), F.round(F.avg("size"), 4).alias("avg_chars"), F.max("size").alias("max_chars"))


# ---- search --------------------------------------------------------------------------------------------------------
def _knn_sql(where: str = "true", k: int = 5) -> str:
    dot = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))"
    unit = "SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v FROM embeddings"
    return f"WITH u AS ({unit}) SELECT query_id, vec_id, score, rank::INTEGER AS rank FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, round({dot}, 6) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round({dot}, 6) DESC, c.vec_id) AS rank FROM u q JOIN u c ON q.vec_id % 100 = 0 AND ({where})) WHERE rank <= {k}"


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding", F.col("label").alias("query_label"))


@query(_knn_sql())
def knn_top_k(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.top_k(_queries(spark, d), table(spark, d, "embeddings"), 5)


@query(_knn_sql("c.label <= 4", 8))
def knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.search(_queries(spark, d), table(spark, d, "embeddings"), 8, F.col("label") <= 4)


_PART = "contains('part-' || (c.vec_id % 7)::VARCHAR, 't-3')"
_named = lambda df: df.withColumn("source_file", F.concat(F.lit("Part-"), F.col("vec_id") % 7))


@query(_knn_sql(_PART, 5))
def knn_contains(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.search(_queries(spark, d), _named(table(spark, d, "embeddings")), 5, contains="T-3")


@query(f"SELECT query_id, vec_id, score, (row_number() OVER (PARTITION BY query_id ORDER BY rank))::INTEGER AS rank FROM ({_knn_sql('true', 25)}) c WHERE {_PART} QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) <= 5")
def knn_overfetch(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.search(_queries(spark, d), _named(table(spark, d, "embeddings")), 5, contains="T-3", overfetch=retrieval.OVERFETCH)


HITS = f"SELECT h.query_id, 'label ' || q.label::VARCHAR AS section, h.rank, c.label = q.label AS content_hit, c.label % 2 = q.label % 2 AS source_hit FROM ({_knn_sql('c.vec_id <> q.vec_id', 5)}) h JOIN embeddings q ON q.vec_id = h.query_id JOIN embeddings c ON c.vec_id = h.vec_id"


@query(f"""
WITH first AS (SELECT query_id, section, min(rank) FILTER (WHERE content_hit) AS content, min(rank) FILTER (WHERE source_hit) AS source FROM ({HITS}) GROUP BY ALL),
each AS (SELECT *, unnest([1, 3, 5]) AS k FROM first)
SELECT coalesce(section, 'all') AS section, k, count(*) AS n, count(*) FILTER (WHERE content <= k) AS content_hits, count(*) FILTER (WHERE source <= k) AS source_hits,
       round(count(*) FILTER (WHERE content <= k) / count(*)::DOUBLE, 4) AS content_rate, round(count(*) FILTER (WHERE source <= k) / count(*)::DOUBLE, 4) AS source_rate
FROM each GROUP BY GROUPING SETS ((k, section), (k))""")
def hit_at_k(spark: SparkSession, d: str) -> DataFrame:
    """Hits of the same label among the nearest vectors other than the query itself."""
    asked, corpus = _queries(spark, d), table(spark, d, "embeddings")
    hits = retrieval.top_k(asked, corpus, 6).where("query_id <> vec_id")
    hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where("rank <= 5")
    told = hits.join(asked.select("query_id", "query_label"), "query_id").join(corpus.select("vec_id", "label"), "vec_id")
    rows = told.select("query_id", F.concat(F.lit("label "), F.col("query_label")).alias("section"), "rank", (F.col("label") == F.col("query_label")).alias("content_hit"), (F.col("label") % 2 == F.col("query_label") % 2).alias("source_hit"))
    return retrieval.hit_rates(rows, "section")


@query("""
WITH needles AS (SELECT DISTINCT lower(unnest(must_contain_any)) AS n FROM eval_items), held AS (SELECT n, count(doc_id) AS docs, min(doc_id) AS first_doc FROM needles LEFT JOIN documents ON contains(lower(text), n) GROUP BY n)
SELECT item_id, section, coalesce(max(docs), 0) AS docs, min(first_doc) AS first_doc, coalesce(bool_or(docs > 0), false) AS found
FROM (SELECT item_id, section, unnest(must_contain_any) AS m FROM eval_items) LEFT JOIN held ON n = lower(m) GROUP BY item_id, section""")
def needle_documents(spark: SparkSession, d: str) -> DataFrame:
    """For each item the documents that contain one of its needles."""
    items = table(spark, d, "eval_items").select("item_id", "section", F.explode("must_contain_any").alias("m")).withColumn("n", F.lower("m"))
    docs = retrieval.needles_found(items.select("n"), table(spark, d, "documents"), "doc_id")
    held = docs.groupBy("n").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"))
    rows = items.join(held, "n", "left").groupBy("item_id", "section")
    return rows.agg(F.coalesce(F.max("docs"), F.lit(0)).alias("docs"), F.min("first_doc").alias("first_doc"), F.coalesce(F.bool_or(F.col("docs") > 0), F.lit(False)).alias("found"))


@query()
def embedded_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunk vectors of the encoder without a model, in batches of like length."""
    return embedding.embed(table(spark, d, "chunks"), "chunk_seq", "text", by_length=True)


# ---- context -------------------------------------------------------------------------------------------------------
CLEAN_CHUNKS = f"SELECT chunk_seq, chunk_id, {CLEAN.format('source_file')} AS source_file, page_start, text FROM chunks"
#: Ten hits of each asked vector; a vector stands for the chunk of its number.
ASKED = f"SELECT k.query_id, k.rank, c.* FROM ({_knn_sql('true', 10)}) k JOIN ({CLEAN_CHUNKS}) c ON c.chunk_seq = k.vec_id"
FIRST_LINKS = f"SELECT path, min_by(role, linked_to) AS role, min(linked_to) AS linked_to FROM ({LINK_TABLE}) GROUP BY path"
NEAREST = f"""
SELECT query_id, rank, n::INTEGER AS n, linked_seq, linked_to, linked_role, linked_page FROM (
  SELECT h.query_id, h.rank, t.chunk_seq AS linked_seq, l.linked_to, CASE WHEN l.role = 'question' THEN 'answer' ELSE 'question' END AS linked_role, coalesce(t.page_start, 0) AS linked_page,
         row_number() OVER (PARTITION BY h.query_id, h.rank ORDER BY abs(coalesce(t.page_start, 0) - coalesce(h.page_start, 0)), coalesce(t.page_start, 0), t.chunk_id, t.chunk_seq) AS n
  FROM ({ASKED}) h JOIN ({FIRST_LINKS}) l ON l.path = h.source_file JOIN ({CLEAN_CHUNKS}) t ON t.source_file = l.linked_to) WHERE n <= 2"""


def _context_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    chunks = table(spark, d, "chunks").select("chunk_seq", "chunk_id", clean_path(F.col("source_file")).alias("source_file"), "page_start", "text")
    found = retrieval.top_k(_queries(spark, d), table(spark, d, "embeddings"), 10).select("query_id", "rank", F.col("vec_id").alias("chunk_seq"))
    hits = found.join(chunks, "chunk_seq")
    links = _links(spark, d).groupBy("path").agg(F.min_by("role", "linked_to").alias("role"), F.min("linked_to").alias("linked_to"))
    return hits, chunks, links


@query(NEAREST)
def nearest_page_links(spark: SparkSession, d: str) -> DataFrame:
    return context.linked_chunks(*_context_inputs(spark, d)).select("query_id", "rank", "n", "linked_seq", "linked_to", "linked_role", "linked_page")


@query(f"SELECT chunk_seq FROM ({CLEAN_CHUNKS}) WHERE source_file IN (SELECT linked_to FROM ({LINK_TABLE}))")
def linked_targets(spark: SparkSession, d: str) -> DataFrame:
    """Chunks whose file some link points to."""
    ends = _links(spark, d).select(F.col("linked_to").alias("source_file")).distinct()
    return table(spark, d, "chunks").select("chunk_seq", clean_path(F.col("source_file")).alias("source_file")).join(ends, "source_file", "left_semi").select("chunk_seq")


BLOCKS = f"""
WITH RECURSIVE hits AS MATERIALIZED ({ASKED}), near AS MATERIALIZED ({NEAREST}),
own AS (SELECT query_id, rank, 0 AS n, '[Excerpt ' || rank::VARCHAR || ' | ' || {BASE.format('source_file')} || ' | p' || coalesce(page_start::VARCHAR, 'None') || ']' || chr(10) || text || chr(10) AS block FROM hits),
more AS (SELECT n.query_id, n.rank, n.n, '[Linked ' || CASE WHEN linked_role = 'answer' THEN 'SOLUTION' ELSE 'QUESTION' END || ' for Excerpt ' || n.rank::VARCHAR || ' | ' || {BASE.format('linked_to')} || ' | p' || coalesce(c.page_start::VARCHAR, 'None') || ']' || chr(10) || c.text || chr(10) AS block
  FROM near n JOIN chunks c ON c.chunk_seq = n.linked_seq ANTI JOIN hits h ON h.query_id = n.query_id AND h.chunk_id = c.chunk_id QUALIFY row_number() OVER (PARTITION BY n.query_id, c.chunk_id ORDER BY n.rank, n.n) = 1),
b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, n) AS i FROM (SELECT * FROM own UNION ALL SELECT * FROM more)),
fold AS (SELECT DISTINCT query_id, 0::BIGINT AS i, 0::BIGINT AS used, false AS ended, []::VARCHAR[] AS kept FROM hits UNION ALL
  SELECT f.query_id, b.i, CASE WHEN NOT ended AND used + length(block) <= 9000 THEN used + length(block) ELSE used END, ended OR (b.n = 0 AND used + length(block) > 9000),
    CASE WHEN NOT ended AND used + length(block) <= 9000 THEN list_append(kept, block) ELSE kept END FROM fold f JOIN b ON b.query_id = f.query_id AND b.i = f.i + 1)
SELECT query_id, array_to_string(kept, chr(10)) AS context, len(kept)::INTEGER AS blocks, used::INTEGER AS used_chars FROM fold QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY i DESC) = 1"""  # fmt: skip


@query(BLOCKS)
def packed_contexts(spark: SparkSession, d: str) -> DataFrame:
    hits, chunks, links = _context_inputs(spark, d)
    return context.contexts(hits, context.linked_chunks(hits, chunks, links))


# ---- generation and its evaluation ---------------------------------------------------------------------------------
#: A reply for each chunk, bare, in a fence, within prose or broken by its number, so that every case occurs.
REPLY = """CASE chunk_seq % 4 WHEN 0 THEN j WHEN 1 THEN concat('Sure:', chr(10), '```json', chr(10), j, chr(10), '```') WHEN 2 THEN concat('Here it is ', j, ' done') ELSE concat('{"questions": [', h) END"""
INNER = """'{"questions": [{"question": "' || h || '", "options": ["' || coalesce(doc_type, '') || '", "' || chunk_type || '", "c' || (chunk_seq % 5)::VARCHAR || '", "c' || (chunk_seq % 3)::VARCHAR || '"], "correct_answer": "c' || (chunk_seq % 7)::VARCHAR || '", "shortcut_used": "' || chunk_type || '"}]}'"""
H = r"regexp_replace(coalesce(heading, ''), '[^A-Za-z0-9 ]', '', 'g')"
QUIZZES = f"SELECT chunk_seq, h, {REPLY} AS raw, chunk_type, doc_type FROM (SELECT *, {INNER} AS j FROM (SELECT *, {H} AS h FROM chunks))"


def _replies(spark: SparkSession, d: str) -> DataFrame:
    h = F.regexp_replace(F.coalesce("heading", F.lit("")), "[^A-Za-z0-9 ]", "")
    n = F.col("chunk_seq")
    pick = lambda m: F.concat(F.lit("c"), (n % m).cast("string"))
    j = F.concat(F.lit('{"questions": [{"question": "'), h, F.lit('", "options": ["'), F.coalesce("doc_type", F.lit("")), F.lit('", "'), "chunk_type", F.lit('", "'), pick(5), F.lit('", "'), pick(3), F.lit('"], "correct_answer": "'), pick(7), F.lit('", "shortcut_used": "'), "chunk_type", F.lit('"}]}'))
    raw = F.when(n % 4 == 0, j).when(n % 4 == 1, F.concat(F.lit("Sure:\n```json\n"), j, F.lit("\n```"))).when(n % 4 == 2, F.concat(F.lit("Here it is "), j, F.lit(" done"))).otherwise(F.concat(F.lit('{"questions": ['), h))
    return table(spark, d, "chunks").select("chunk_seq", "chunk_type", "doc_type", raw.alias("raw"))


@query(f"""
SELECT chunk_seq, q IS NOT NULL AS recovered, coalesce(length(q ->> '$.questions[0].question') >= 10 AND json_array_length(q, '$.questions[0].options') = 4
  AND list_contains(from_json(q -> '$.questions[0].options', '["VARCHAR"]'), q ->> '$.questions[0].correct_answer') AND length(q ->> '$.questions[0].shortcut_used') >= 5, false) AS valid,
  coalesce(len(list_distinct(from_json(q -> '$.questions[0].options', '["VARCHAR"]'))) = 4, false) AS distinct_options
FROM (SELECT chunk_seq, CASE WHEN json_valid(p) THEN p WHEN json_valid(i) THEN i END AS q FROM (
  SELECT chunk_seq, p, regexp_extract(p, '(?s)\\{{.*\\}}') AS i FROM (SELECT chunk_seq, CASE WHEN contains(raw, '```') THEN trim(regexp_extract(raw, '(?s)```(?:json)?\\s*(.*?)```', 1), chr(10) || ' ') ELSE trim(raw) END AS p FROM ({QUIZZES}))))""".replace("\\\\", "\\"))  # fmt: skip
def quiz_validation(spark: SparkSession, d: str) -> DataFrame:
    q = F.from_json("json", generation.QUIZ)
    rows = _replies(spark, d).withColumn("json", generation.recovered_json(F.col("raw"))).withColumn("q", q)
    options = F.get(F.col("q.questions"), F.lit(0))["options"]
    return rows.select("chunk_seq", F.col("json").isNotNull().alias("recovered"), generation.valid_quiz(F.col("q")).alias("valid"), F.coalesce(generation.distinct_options(options), F.lit(False)).alias("distinct_options"))


STOPS = ", ".join(f"'{w}'" for w in X.STOPWORDS)
GROUNDED = f"""
SELECT chunk_seq, chunk_type, CASE WHEN len(w) = 0 THEN 0.0::DOUBLE ELSE round(len(list_intersect(w, regexp_extract_all(lower(text), '[a-z]{{4,}}'))) / len(w)::DOUBLE, 2) END AS lexical
FROM (SELECT *, list_filter(list_distinct(regexp_extract_all(lower(coalesce(heading, '')), '[a-z]{{4,}}')), lambda x: NOT list_contains([{STOPS}], x)) AS w FROM chunks)"""


@query(f"SELECT chunk_seq, lexical FROM ({GROUNDED})")
def grounding_score(spark: SparkSession, d: str) -> DataFrame:
    """How much of a chunk's heading its text bears out."""
    return table(spark, d, "chunks").select("chunk_seq", F.round(X.grounding(F.col("heading"), F.col("text")), 2).alias("lexical"))


@query(f"""SELECT chunk_type AS section, count(*) AS n, round(avg(CASE WHEN judged THEN (chunk_seq % 3 = 0)::INT END), 4) AS correct_rate, round(avg(CASE WHEN judged THEN (lexical >= 0.5)::INT END), 4) AS grounded_rate,
round(avg((chunk_seq % 4 <> 0)::INT), 4) AS distinct_rate, round(coalesce(avg(lexical), 0), 4) AS avg_lexical FROM (SELECT *, chunk_seq % 5 <> 0 AS judged FROM ({GROUNDED})) GROUP BY chunk_type""")
def evaluation_rates(spark: SparkSession, d: str) -> DataFrame:
    scored = table(spark, d, "chunks").select("chunk_seq", F.col("chunk_type").alias("section"), F.round(X.grounding(F.col("heading"), F.col("text")), 2).alias("lexical"))
    n, judged = F.col("chunk_seq"), F.col("chunk_seq") % 5 != 0
    rows = scored.select("section", "lexical", F.when(judged, n % 3 == 0).alias("correct"), F.when(judged, F.col("lexical") >= 0.5).alias("grounded"), (n % 4 != 0).alias("distinct_options"))
    return generation.evaluation_rates(rows, "section")


# ---- incremental ---------------------------------------------------------------------------------------------------
@query(f"SELECT DISTINCT {CLEAN.format('path')} AS path FROM extract_log WHERE status = 'ok' AND {CLEAN.format('path')} NOT IN ({FILES})")
def files_to_chunk(spark: SparkSession, d: str) -> DataFrame:
    """Extracted files that have no chunks yet."""
    ok = table(spark, d, "extract_log").where("status = 'ok'").select(clean_path(F.col("path")).alias("path")).distinct()
    return incremental.remaining(ok, _files(spark, d), "path")


@query("SELECT chunk_seq, chunk_id FROM (SELECT chunk_seq, chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY chunk_seq) AS r FROM chunks) WHERE r = 1")
def first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Each chunk_id once, by its first delivery."""
    return table(spark, d, "chunks").groupBy("chunk_id").agg(F.min("chunk_seq").alias("chunk_seq")).select("chunk_seq", "chunk_id")


@query(f"SELECT chunk_seq, CASE WHEN page_start IS NOT DISTINCT FROM page_end THEN 'p' || page_start::VARCHAR ELSE 'p' || page_start::VARCHAR || '-' || page_end::VARCHAR END AS label, left(replace(text, chr(10), ' '), 150) AS preview FROM chunks WHERE page_start IS NOT NULL AND page_end IS NOT NULL")
def hit_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").where("page_start IS NOT NULL AND page_end IS NOT NULL")
    return rows.select("chunk_seq", X.page_label(F.col("page_start"), F.col("page_end")).alias("label"), F.substring(F.replace("text", F.lit("\n"), F.lit(" ")), 1, 150).alias("preview"))
