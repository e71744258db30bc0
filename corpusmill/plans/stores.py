"""Registered queries that write tables to stores and read them back, or go through adapters, beside their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.paths import clean_path, site_of
from ..operators import embedding, generation, quality, retrieval, survey
from ..sources import files, sinks
from ..sources.scratch import scratch
from ..sources.tables import table
from ..streaming.ingest import ingest_new
from . import catalogue as C
from .catalogue import query

STORED = "chunk_id, source_file, doc_type, chunk_type, heading, page_start, page_end, text, char_count"


@query(f"SELECT {STORED} FROM chunks")
def stored_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The chunk store as JSON lines, written anew and read again."""
    path = scratch(spark, "chunk-store")
    sinks.rebuild(table(spark, d, "chunks").selectExpr(*STORED.split(", ")), path)
    return files.chunk_store(spark, path).selectExpr(*STORED.split(", "))


@query(r"SELECT replace(path, '\', '/') AS path, qa_role AS role, replace(linked_to, '\', '/') AS linked_to FROM qa_links")
def stored_links(spark: SparkSession, d: str) -> DataFrame:
    """The table of links as JSON lines, read with one kind of separator."""
    path = scratch(spark, "links")
    sinks.rebuild(table(spark, d, "qa_links").select("path", F.col("qa_role").alias("role"), "linked_to", "match_type"), path)
    return files.link_table(spark, path).select("path", "role", "linked_to")


@query("SELECT source_rel, doc_type, page_num, method, md5(text) AS text_md5 FROM page_extracts")
def cached_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages out of a cache of extractions, one JSON document each."""
    path = scratch(spark, "extractions")
    page = F.struct("page_num", "text", "method", F.array().cast("array<struct<text:string>>").alias("spans"), F.array().cast("array<array<array<string>>>").alias("tables"))
    sinks.rebuild(table(spark, d, "page_extracts").select(F.col("source_rel").alias("path"), "source_rel", "doc_type", F.array(page).alias("pages"), "errors"), path)
    return files.extractions(spark, path)[0].select("source_rel", "doc_type", "page_num", "method", F.md5("text").alias("text_md5"))


@query("SELECT source_rel, count(DISTINCT page_num) AS n_pages FROM page_extracts GROUP BY source_rel")
def counted_pages(spark: SparkSession, d: str) -> DataFrame:
    return files.page_counts(table(spark, d, "page_extracts"))


@query("SELECT vec_id::VARCHAR AS chunk_id, label, len(embedding)::INTEGER AS dim FROM embeddings")
def loaded_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors loaded in two steps: those of label 0 to 4 anew, then all that the store does not have yet."""
    path = scratch(spark, "vectors")
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "label", "embedding")
    sinks.load_vectors(vectors.where("label < 5"), path)
    sinks.load_vectors(vectors, path, resume=True)
    return spark.read.parquet(path).select("chunk_id", "label", F.size("embedding").alias("dim"))


@query(f"SELECT path, n_pages FROM ({C.LATEST}) WHERE n_pages IS NOT NULL")
def page_census_file(spark: SparkSession, d: str) -> DataFrame:
    """The page census as a tab-separated file, largest files first."""
    path = scratch(spark, "census")
    sinks.tsv(survey.latest_log(table(spark, d, "extract_log")).where("n_pages IS NOT NULL").select("n_pages", "path").orderBy(F.desc("n_pages"), F.desc("path")), path)
    return spark.read.option("sep", "\t").schema("n_pages int, path string").csv(path).select("path", "n_pages")


@query(f"SELECT count(*) FILTER (WHERE error IS NULL AND n_pages IS NOT NULL) AS files, coalesce(sum(n_pages) FILTER (WHERE error IS NULL), 0)::BIGINT AS pages, count(*) FILTER (WHERE error IS NOT NULL) AS errors FROM ({C.LATEST})")
def page_census(spark: SparkSession, d: str) -> DataFrame:
    return survey.census(survey.latest_log(table(spark, d, "extract_log")))


@query("SELECT status, count(*) AS files FROM extract_log GROUP BY status")
def reported_status(spark: SparkSession, d: str) -> DataFrame:
    """Counts written as a report and as an appended log, read again."""
    path, log = scratch(spark, "report"), scratch(spark, "log")
    counts = table(spark, d, "extract_log").groupBy("status").agg(F.count("*").alias("files"))
    sinks.append_log(counts, log)
    sinks.report(spark.read.schema("status string, files long").json(log), path, dated=True)
    return spark.read.schema("status string, files long, generated_at string").json(path).where("generated_at IS NOT NULL").select("status", "files")


def _again(file: str, page: int) -> str:
    """A reader in place of an OCR engine: some pages cannot be read."""
    if page % 5 == 0:
        raise RuntimeError("no image")
    return f"{file} page {page} " * 3


@query(f"""
WITH bad AS (SELECT DISTINCT source_rel, page_num FROM ({C.PAGE_VERDICT}) WHERE verdict <> 'CLEAN'),
tried AS (SELECT *, coalesce(sum((page_num % 5 <> 0)::INT) OVER (PARTITION BY source_rel ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 60 AS within, repeat(source_rel || ' page ' || page_num::VARCHAR || ' ', 3) AS new FROM bad),
pages AS (SELECT p.page_id, p.method, p.text, t.within, t.page_num % 5 <> 0 AS could, CASE WHEN v.verdict <> 'CLEAN' AND t.within AND t.page_num % 5 <> 0 AND length(trim(t.new)) > length({C.STRIP % "coalesce(p.text, '')"}) THEN t.new END AS new, v.verdict <> 'CLEAN' AS bad
  FROM page_extracts p JOIN ({C.PAGE_VERDICT}) v USING (page_id) LEFT JOIN tried t ON t.source_rel = p.source_rel AND t.page_num = p.page_num)
SELECT page_id, CASE WHEN new IS NOT NULL THEN 'ocr' ELSE method END AS method, md5(coalesce(new, text)) AS text_md5, CASE WHEN bad AND NOT within THEN 'budget' WHEN bad AND NOT could THEN 'failed' END AS note FROM pages""")
def reread_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that are not clean, read again within each file's budget of successful readings."""
    done = quality.ocr_fallback(table(spark, d, "page_extracts").select("page_id", "source_rel", "page_num", "text", "method"), _again)
    note = F.when(F.contains("note", F.lit("budget")), "budget").when(F.contains("note", F.lit("failed")), "failed")
    return done.select("page_id", "method", F.md5("text").alias("text_md5"), note.alias("note"))


# ---- search hits and their judgement -------------------------------------------------------------------------------
SHOWN = f"SELECT k.query_id, k.rank, k.score, c.source_file, nullif(c.heading, '') AS heading, c.page_start, c.text FROM ({C._knn_sql('true', 10)}) k JOIN (SELECT chunk_seq, {C.CLEAN.format('source_file')} AS source_file, coalesce(heading, '') AS heading, page_start, text FROM chunks) c ON c.chunk_seq = k.vec_id"


def _shown(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunks").select("chunk_seq", clean_path(F.col("source_file")).alias("source_file"), F.coalesce("heading", F.lit("")).alias("heading"), "page_start", "text")
    return retrieval.projected(retrieval.top_k(C._queries(spark, d), table(spark, d, "embeddings"), 10), chunks)


@query(f"SELECT query_id, rank, round(1 - (1 - score), 6) AS score, source_file, heading, page_start FROM ({SHOWN})")
def shown_hits(spark: SparkSession, d: str) -> DataFrame:
    return _shown(spark, d).select("query_id", "rank", "score", "source_file", "heading", "page_start")


@query(f"""
WITH shown AS MATERIALIZED ({SHOWN}),
asked AS (SELECT query_id, coalesce(any_value(coalesce(heading, 'none')) FILTER (WHERE rank = r), 'none') AS section, any_value(regexp_extract_all(coalesce(heading, ''), '[A-Za-z]{{4,}}')) FILTER (WHERE rank = r) AS needles, any_value(regexp_extract(source_file, '^[^/]*')) FILTER (WHERE rank = r) AS site
  FROM (SELECT *, min(rank) OVER (PARTITION BY query_id) AS r FROM shown) GROUP BY query_id),
hits AS (SELECT s.query_id, a.section, s.rank, len(list_filter(a.needles, lambda n: contains(lower(s.text), lower(n)))) > 0 AS content_hit, contains(lower(s.source_file), lower(a.site)) AS source_hit FROM shown s JOIN asked a USING (query_id)),
first AS (SELECT query_id, section, min(rank) FILTER (WHERE content_hit) AS content, min(rank) FILTER (WHERE source_hit) AS source FROM hits GROUP BY ALL),
each AS (SELECT *, unnest([1, 3, 5]) AS k FROM first)
SELECT coalesce(section, 'all') AS section, k, count(*) AS n, count(*) FILTER (WHERE content <= k) AS content_hits, count(*) FILTER (WHERE source <= k) AS source_hits,
       round(count(*) FILTER (WHERE content <= k) / count(*)::DOUBLE, 4) AS content_rate, round(count(*) FILTER (WHERE source <= k) / count(*)::DOUBLE, 4) AS source_rate
FROM each GROUP BY GROUPING SETS ((k, section), (k))""")
def content_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits whose text has a word of the first hit's heading, and hits from its site, by that heading."""
    shown = _shown(spark, d)
    first = F.min(F.struct("rank", F.coalesce("heading", F.lit("none")).alias("section"), F.regexp_extract_all(F.coalesce("heading", F.lit("")), F.lit("[A-Za-z]{4,}"), F.lit(0)).alias("needles"), site_of(F.col("source_file")).alias("site")))
    asked = shown.groupBy("query_id").agg(first.alias("a")).select("query_id", "a.section", "a.needles", F.array("a.site").alias("sources"))
    rows = shown.join(asked, "query_id").select("query_id", "section", "rank", retrieval.any_contains(F.col("text"), F.col("needles")).alias("content_hit"), retrieval.any_contains(F.col("source_file"), F.col("sources")).alias("source_hit"))
    return retrieval.hit_rates(rows, "section")


# ---- labels, requests, answers -------------------------------------------------------------------------------------
@query(f"SELECT path, total, CASE WHEN total < 1024 THEN format('{{:.1f}} B', total::DOUBLE) WHEN total < 1048576 THEN format('{{:.1f}} KB', total / 1024.0::DOUBLE) ELSE format('{{:.1f}} MB', total / 1048576.0::DOUBLE) END AS size FROM (SELECT {C.CLEAN.format('source_file')} AS path, sum(strlen(text))::BIGINT AS total FROM chunks GROUP BY 1)")
def file_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of text in each file, for people to read."""
    sizes = table(spark, d, "chunks").groupBy(clean_path(F.col("source_file")).alias("path")).agg(F.sum(F.octet_length("text")).alias("total"))
    return sizes.select("path", "total", X.human_size(F.col("total")).alias("size"))


@query("SELECT item_id, CASE WHEN NOT coalesce(length(trim(topic)) BETWEEN 2 AND 200, false) THEN 'topic' WHEN NOT length(question) % 11 BETWEEN 1 AND 8 THEN 'n' WHEN NOT length(question) % 15 BETWEEN 2 AND 12 THEN 'k' END AS fault FROM eval_items")
def request_faults(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with requests about the items' topics, for numbers drawn from their questions."""
    return table(spark, d, "eval_items").select("item_id", generation.request_fault(F.col("topic"), F.length("question") % 11, F.length("question") % 15).alias("fault"))


@query("SELECT chunk_seq, coalesce(qa_role = linked_role, false) AS is_right FROM (SELECT chunk_seq, qa_role, CASE WHEN linked_source IS NOT NULL THEN 'question' END AS linked_role FROM chunks)")
def graded_roles(spark: SparkSession, d: str) -> DataFrame:
    """Answers that may be missing, against the right one."""
    answers = table(spark, d, "chunks").select("chunk_seq", F.col("qa_role").alias("chosen"), F.when(F.col("linked_source").isNotNull(), "question").alias("correct_answer"))
    return generation.graded(answers).select("chunk_seq", "is_right")


@query("SELECT chunk_seq, chunk_id FROM (SELECT chunk_seq, chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY chunk_seq) AS r FROM chunks) WHERE r = 1")
def ingested_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks streamed into a table, each chunk_id once, by its first delivery."""
    # as a pattern, for a stream takes a plain path for a folder and the table may be one file
    target, checkpoint = scratch(spark, "ingested"), scratch(spark, "ingest-checkpoint")
    stream = ingest_new(spark, f"{d}/chunk[s].parquet", target, checkpoint, order="chunk_seq")
    stream.awaitTermination()
    return spark.read.parquet(target).select("chunk_seq", "chunk_id")


@query(f"SELECT source_file, chunk_id, (row_number() OVER (PARTITION BY source_file, page ORDER BY chunk_id, chunk_seq))::INTEGER AS place FROM (SELECT {C.CLEAN.format('source_file')} AS source_file, coalesce(page_start, 0) AS page, chunk_id, chunk_seq FROM chunks)")
def store_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of each chunk on its page in the order of the store, ids compared as strings."""
    rows = table(spark, d, "chunks").select(clean_path(F.col("source_file")).alias("source_file"), F.coalesce("page_start", F.lit(0)).alias("page"), "chunk_id", "chunk_seq")
    return rows.select("source_file", "chunk_id", F.row_number().over(Window.partitionBy("source_file", "page").orderBy("chunk_id", "chunk_seq")).alias("place"))


# ---- adapters: encoders and models ---------------------------------------------------------------------------------
def _encoded(texts: str) -> str:
    """SQL for the encoder without a model: out of (id, text) the places of each vector that are not 0."""
    words = f"SELECT id, unnest(list_filter(string_split_regex(lower(text), '[{X.WHITE}]+'), lambda x: x <> '')) AS w FROM ({texts})"
    places = f"SELECT id, (h % 64)::INTEGER AS dim, sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END)::DOUBLE AS v FROM (SELECT id, ('0x' || substring(md5(w), 1, 8))::UBIGINT AS h FROM ({words})) GROUP BY ALL"
    return f"SELECT id, dim, (v / sqrt(sum(v * v) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS value FROM ({places}) QUALIFY v <> 0"


def _places(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(F.col(key).alias("id"), F.posexplode("embedding").alias("dim", "v")).where("v <> 0").select("id", "dim", F.col("v").cast("double").alias("value"))


@query(_encoded("SELECT chunk_seq AS id, text FROM chunks"))
def embedding_values(spark: SparkSession, d: str) -> DataFrame:
    """Passages encoded in batches of like length, place by place."""
    return _places(embedding.embed(table(spark, d, "chunks"), "chunk_seq", "text", by_length=True), "chunk_seq")


@query(_encoded(f"SELECT item_id AS id, '{embedding.QUERY_PREFIX}' || question AS text FROM eval_items WHERE question IS NOT NULL"))
def question_values(spark: SparkSession, d: str) -> DataFrame:
    """Questions encoded with the prefix that some models want for queries only."""
    return _places(embedding.embed(table(spark, d, "eval_items"), "item_id", "question", model="bge-small", queries=True), "item_id")


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE status IS DISTINCT FROM 'ok') AS failed FROM extract_log")
def observed_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters that are filled while the log is written elsewhere."""
    rows, counters = survey.observed(table(spark, d, "extract_log").select("log_id", "status"))
    rows.write.parquet(scratch(spark, "log-copy"))
    return spark.createDataFrame([(counters.get["rows"], counters.get["failed"])], "rows long, failed long")


#: A model in place of a provider: what it answers follows from the length of the prompt.
MADE = {"questions": [{"question": "How far does the cart go?", "options": ["one", "two", "three", "four"], "correct_answer": "two", "shortcut_used": "count the velvet orchard wheels"}]}


def _model(prompt: str) -> str:
    kind = len(prompt) % 4
    if kind == 2:
        raise TimeoutError("late")
    good = json.dumps(MADE)
    return good if kind == 0 else f"Here:\n```json\n{good}\n```" if kind == 1 else '{"questions": [{"question": "Why?"}]}'


def _judge(prompt: str) -> str:
    kind = len(prompt) % 3
    return json.dumps({"answer_correct": kind > 0, "shortcut_grounded": kind > 1, "confidence": 0.5, "notes": ""})


_PROMPT = len(f"{generation.SYSTEM}\n\nTopic: \nQuestions: 3\n\nExcerpts:\n")
_JUDGED = len(f"{generation.JUDGE}\n\nQuestion: \n\nExcerpts:\n") + len(json.dumps(MADE["questions"][0], separators=(",", ":")))
GENERATED = f"""
SELECT item_id, topic, context, coalesce(trim(context) = '', true) AS none, (length(topic) + length(context) + {_PROMPT}) % 4 AS kind FROM (SELECT item_id, topic, passage AS context FROM eval_items)"""


def _generated(spark: SparkSession, d: str) -> DataFrame:
    contexts = table(spark, d, "eval_items").select("item_id", "topic", F.col("passage").alias("context"))
    return generation.quizzes(contexts, generation.retried(_model))


@query(f"SELECT item_id, coalesce(NOT none AND kind < 2, false) AS valid, CASE WHEN none THEN 'nothing was found' WHEN kind = 2 THEN 'TimeoutError: late' WHEN kind = 3 THEN 'the reply is no valid quiz' END AS error FROM ({GENERATED})")
def generated_quizzes(spark: SparkSession, d: str) -> DataFrame:
    """Quizzes about each item's passage: recovered, validated, failed or refused."""
    return _generated(spark, d).select("item_id", "valid", "error")


@query(f"""
SELECT item_id, (length(context) + {_JUDGED}) % 3 > 1 AS ok, round_even(len(list_intersect(w, regexp_extract_all(lower(context), '[a-z]{{4,}}'))) / len(w)::DOUBLE, 2) AS lexical, true AS distinct_options
FROM (SELECT *, ['count', 'velvet', 'orchard', 'wheels'] AS w FROM ({GENERATED})) WHERE NOT none AND kind < 2""")
def judged_quizzes(spark: SparkSession, d: str) -> DataFrame:
    """Every question of the valid quizzes with its lexical score and a judge's verdict."""
    return generation.judged(_generated(spark, d), _judge).select("item_id", "ok", "lexical", "distinct_options")
