from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.operators import chunking, context, dedup, embedding, generation, incremental, linking, quality, retrieval, survey
from corpusmill.sources import files, sinks
from corpusmill.streaming.ingest import ingest_new


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_body_size_is_the_first_seen_mode_half_to_even(spark):
    data = [("a", i, s) for i, s in enumerate([10.5, 10.2, 11.4, 11.0])] + [("b", i, s) for i, s in enumerate([12.0, 10.0, 10.0, 12.0])] + [("c", 0, None)]
    df = spark.createDataFrame(data, "doc string, pos int, size double")
    assert rows(chunking.body_size(df, "doc", ["pos"])) == [("a", 10.0), ("b", 12.0)]


def test_headings(spark):
    cases = [("Chapter One", 11.5, False, True), ("12 - 3", 20.0, True, False), ("Bold line", 10.5, True, True), ("Bold line", 10.5, False, False), ("x" * 121, 20.0, True, False), ("ab", 20.0, True, False), ("None", None, True, False)]
    df = spark.createDataFrame([(i, t, s, b) for i, (t, s, b, _) in enumerate(cases)], "i int, text string, size double, bold boolean").withColumn("body", F.lit(10.0))
    found = df.select("i", chunking.is_heading(F.col("text"), F.col("size"), F.col("bold"), F.col("body")))
    assert [r[1] for r in found.orderBy("i").collect()] == [c[3] for c in cases]


def pages(spark, data):
    return spark.createDataFrame(data, schemas.PAGES)


def span(text, size=10.0, bold=False):
    return {"text": text, "size": size, "bold": bold, "bbox": None}


def test_chunks_of_sections_and_tables(spark):
    one = [span("lead line that is long enough"), span("First Heading", 14.0), span("body of the first section, long enough"), span("more body of it")]
    two = [span("Second Heading", 14.0), span("body of the second section, long enough")]
    table = [["name", "value"], ["a", None], ["b", "2"]]
    df = pages(spark, [("d.pdf", "pdf", 1, "ignored", "pymupdf", one, [table, [["x"]]]), ("d.pdf", "pdf", 2, "", "pymupdf", two, [])])
    got = {r["chunk_id"]: r for r in chunking.chunk_documents(df).collect()}
    assert set(got) == {"d.pdf::text::0", "d.pdf::text::1", "d.pdf::text::2", "d.pdf::table::1::0::0"}
    assert got["d.pdf::text::1"]["text"] == "body of the first section, long enough\nmore body of it"
    assert got["d.pdf::text::1"]["heading"] == "First Heading" and got["d.pdf::text::0"]["heading"] is None
    assert got["d.pdf::table::1::0::0"]["text"] == "name | value\na | \nb | 2" and got["d.pdf::table::1::0::0"]["heading"] is None  # the first section on the page has none


def test_chunks_without_headings_are_packed_by_lines(spark):
    df = pages(spark, [("d.html", "html", 0, "first line of text\nsecond line of text\n\n", "bs4", [], []), ("e.html", "html", 0, None, "bs4", [], [])])
    assert [(r["chunk_id"], r["text"]) for r in chunking.chunk_documents(df).collect()] == [("d.html::text::0", "first line of text\nsecond line of text")]


def test_plausible_tables(spark):
    tables = [[["a", "b"], ["c", "d"]], [["a", "b"]], [["a"], ["b"]], [["a", "b"], ["x" * 401, "d"]], [["a", None], [None, "d"]], None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tables)], "i int, t array<array<string>>")
    assert [r[0] for r in df.orderBy("i").select(chunking.plausible_table(F.col("t"))).collect()] == [True, False, False, False, True, False]


def chunks(spark, data):
    return spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(data)], "chunk_seq long, source_file string, text string")


def test_winner_has_fewest_folders(spark):
    won = dedup.winners(chunks(spark, [("A/B/x.pdf", "t"), ("A/xxxxxxxx.pdf", "t"), ("A/xxxxxxxx.pdf", "t"), ("A/y.pdf", None)]))
    assert rows(won.where("survives").select("chunk_seq", "winner")) == [(1, "A/xxxxxxxx.pdf"), (3, "A/y.pdf")]


def test_alias_is_the_plurality_of_votes(spark):
    won = spark.createDataFrame([(0, "F", "G"), (1, "F", "F"), (2, "F", "G"), (3, "H", "H"), (4, "H", "G"), (5, "K", "A"), (6, "K", "B")], "chunk_seq long, source_file string, winner string")
    assert rows(dedup.aliases(won)) == [("F", "G"), ("K", "A")]


def test_remapped_links_drop_self_links_and_keep_the_last(spark):
    links = spark.createDataFrame([("P", "question", "Q", "m", 1), ("S", "question", "T", "m", 2), ("S2", "answer", "U", "m", 3)], "path string, role string, linked_to string, match_type string, link_no int")
    alias = spark.createDataFrame([("P", "R"), ("Q", "R"), ("S2", "S")], "original_file string, winner_file string")
    assert rows(dedup.remap_links(links, alias)) == [("S", "answer", "U", "m")]


def link_rows(spark, paths):
    return rows(linking.all_links(spark.createDataFrame([(p,) for p in paths], "path string")))


def test_links_of_folders_and_siblings(spark):
    got = link_rows(spark, ["x/Question/07.pdf", "x/Answer_/07.pdf", "x/Question/NMAT 1.pdf", "x/Answer_/NMAT1.pdf", "x/Question/Mock 2 Q.pdf", "x/Answer_/Mock 2 sol.pdf"])
    kinds = {(p, role): kind for p, role, _, kind in got}
    assert kinds[("x/Question/07.pdf", "question")] == "folder_pair+exact_filename"
    assert kinds[("x/Answer_/Mock 2 sol.pdf", "answer")] == "folder_pair+fuzzy_filename"
    assert kinds[("x/Answer_/NMAT1.pdf", "answer")] == "folder_pair+fuzzy_filename+loose"
    assert link_rows(spark, ["y/IIFT 2020.pdf", "y/IIFT 2020 Soln.pdf"]) == [("y/IIFT 2020 Soln.pdf", "answer", "y/IIFT 2020.pdf", "same_folder_filename"), ("y/IIFT 2020.pdf", "question", "y/IIFT 2020 Soln.pdf", "same_folder_filename")]


def test_links_need_two_and_different_roles(spark):
    assert link_rows(spark, ["y/a.pdf", "y/a sol.pdf", "y/a key.pdf"]) == []
    assert link_rows(spark, ["y/a sol.pdf", "y/a key.pdf"]) == []
    assert link_rows(spark, ["CDC- LRDI/a.pdf", "CDC- LRDT Sol_/a.pdf"]) == []
    # the first of an unmarked and a question file becomes the question, the other one the answer
    assert link_rows(spark, ["y/a.pdf", "y/a q.pdf"]) == [("y/a q.pdf", "question", "y/a.pdf", "same_folder_filename"), ("y/a.pdf", "answer", "y/a q.pdf", "same_folder_filename")]
    assert link_rows(spark, []) == []


def test_third_folder_of_folders_makes_a_pair_ambiguous(spark):
    assert link_rows(spark, ["A/Question/1.pdf", "A/Answer/1.pdf", "A/Questions/sub/x.pdf"]) == []
    assert len(link_rows(spark, ["A/Question/1.pdf", "A/Answer/1.pdf", "A/Notes/sub/x.pdf"])) == 2
    assert len(link_rows(spark, ["Question/deep/1.pdf", "Question/2.pdf", "Answer/2.pdf", "Answer/deep/1.pdf"])) == 2  # folders right below the root
    folders = linking.folders_of(spark.createDataFrame([("a/b/c.pdf",), ("d.pdf",), ("a/b/e/f.pdf",)], "path string"))
    assert rows(folders) == [("",), ("a",), ("a/b",), ("a/b/e",)]


def brute_links(paths):
    """The rule read word for word, file by file."""
    import itertools
    import re

    from corpusmill.functions import text as X

    words = lambda n: [t for t in re.split("[^a-z0-9]+", n.lower()) if t]
    role = lambda n: "answer" if set(words(n)) & set(X.ANSWER_WORDS) else "question" if set(words(n)) & set(X.QUESTION_WORDS) else "unmarked"
    sig = lambda n: " ".join(t for t in words(n) if t not in X.ANSWER_WORDS + X.QUESTION_WORDS)
    stem = lambda p: re.sub(r"(?<=.)\.[^.]*$", "", p.rpartition("/")[2])
    folders = {p.rpartition("/")[0] for p in paths}
    folders |= {"/".join(f.split("/")[:n]) for f in folders for n in range(1, f.count("/") + 1)}
    out = {}

    def put(a, b, ra, rb, kind):
        if ra != rb:
            first = "question" if ra != "answer" else "answer"
            out[a], out[b] = (first, b, kind), ("answer" if first == "question" else "question", a, kind)

    groups = {}
    for f in sorted(folders - {""}):
        groups.setdefault((f.rpartition("/")[0], sig(f.rpartition("/")[2])), []).append(f)
    for pair in (g for g in groups.values() if len(g) == 2):
        ra, rb = (role(f.rpartition("/")[2]) for f in pair)
        if ra == rb:
            continue
        left, right = ({p.rpartition("/")[2]: p for p in paths if p.rpartition("/")[0] == f} for f in pair)
        for n in left.keys() & right.keys():
            put(left[n], right[n], ra, rb, "folder_pair+exact_filename")
        l, r = [p for n, p in left.items() if n not in right], [p for n, p in right.items() if n not in left]
        for kind, key, same in (("", lambda p: sig(stem(p)), None), ("+loose", lambda p: sig(stem(p)).replace(" ", ""), True)):
            if same:
                l, r = [p for p in l if sig(stem(p)) not in {sig(stem(x)) for x in r}], [p for p in r if sig(stem(p)) not in {sig(stem(x)) for x in l}]
            for a, b in itertools.product(l, r):
                if key(a) == key(b) != "" and [key(x) for x in l].count(key(a)) == 1 == [key(x) for x in r].count(key(a)):
                    put(a, b, ra, rb, "folder_pair+fuzzy_filename" + kind)
    linked, beside = set(out), {}
    for p in sorted(paths):
        if sig(stem(p)):
            beside.setdefault((p.rpartition("/")[0], sig(stem(p))), []).append(p)
    for a, b in (g for g in beside.values() if len(g) == 2):
        if a not in linked and b not in linked:
            put(a, b, role(stem(a)), role(stem(b)), "same_folder_filename")
    return sorted(((p, *v) for p, v in out.items()), key=str)


def test_links_against_brute_force(spark):
    import random

    r = random.Random(4)
    for _ in range(3):
        folders = [f"{s}/{t}" for s in ("S", "S/T", "U") for t in ("Question", "Answer_", "Notes", "Questions 2", "Sol 2")] + ["", "V/Key/deep"]
        names = ["01", "NMAT 1", "NMAT1", "Mock 2 Q", "Mock 2 sol", "Mock 2", "Q", "sol", "a b", "ab"]
        paths = sorted({f"{f}/{r.choice(names)}.{r.choice(['pdf', 'docx'])}".lstrip("/") for f in folders for _ in range(6)})
        assert link_rows(spark, paths) == brute_links(paths)


def test_asymmetric_links(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "d")], "path string, linked_to string")
    assert rows(linking.asymmetric(links)) == [("c", "d")]


def test_nearest_pages_and_budget(spark):
    hits = spark.createDataFrame([(1, 1, "q::0", "q.pdf", 3, "P" * 10)], "query_id long, rank int, chunk_id string, source_file string, page_start int, text string")
    links = spark.createDataFrame([("q.pdf", "question", "a.pdf")], "path string, role string, linked_to string")
    store = spark.createDataFrame([(i, f"a::{i}", "a.pdf", p, "L") for i, p in enumerate([1, 2, 4, 4])] + [(9, "z", "other.pdf", 3, "x")], "chunk_seq long, chunk_id string, source_file string, page_start int, text string")
    near = context.linked_chunks(hits, store, links)
    assert [(r["linked_page"], r["linked_role"]) for r in near.orderBy("n").collect()] == [(2, "answer"), (4, "answer")]
    whole = context.contexts(hits, near).first()
    assert whole["context"].startswith("[Excerpt 1 | q.pdf | p3]\nPPPPPPPPPP\n\n[Linked SOLUTION for Excerpt 1 | a.pdf | p2]\nL\n") and whole["blocks"] == 3


def test_budget_stops_at_a_hit_and_passes_over_linked_blocks(spark):
    pad = lambda n: "x" * n
    head = len("[Excerpt 1 | f | p1]\n\n")
    linked_head = len("[Linked SOLUTION for Excerpt 1 | g | p1]\n\n")
    hits = spark.createDataFrame([(1, 1, "p1", "f", 1, pad(60)), (1, 2, "p2", "f", 1, pad(20)), (1, 3, "p3", "f", 1, pad(1))], "query_id long, rank int, chunk_id string, source_file string, page_start int, text string")
    linked = spark.createDataFrame([(1, 1, 1, "g", "answer", "l1", 1, pad(50 + head)), (1, 1, 2, "g", "answer", "l2", 1, pad(10))], "query_id long, rank int, n int, linked_to string, linked_role string, linked_id string, linked_start int, linked_text string")
    got = context.contexts(hits, linked, budget=60 + head + linked_head + 10 + 5).first()
    assert got["blocks"] == 2 and got["used_chars"] == 60 + head + 10 + linked_head


def test_needles_in_blocks(spark):
    needles = spark.createDataFrame([("Abc",), ("b",), ("",), (None,), ("abc",)], "n string")
    texts = spark.createDataFrame([(1, "xABCx"), (2, "B"), (3, None), (4, "")], "id int, text string")
    for block in (10, 1):
        assert rows(retrieval.needles_found(needles, texts, "id", block=block)) == [(1, "abc"), (1, "b"), (2, "b")]


def test_search_ranks_ties_by_id(spark):
    corpus = spark.createDataFrame([(3, [1.0, 0.0], "a/X.pdf"), (1, [2.0, 0.0], "b/y.pdf"), (2, [0.0, 1.0], "a/x.pdf"), (4, [0.0, 0.0], "a"), (5, None, "a"), (6, [1.0], "a")], "vec_id long, embedding array<float>, source_file string")
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id long, embedding array<float>")
    assert [(r["vec_id"], r["rank"]) for r in retrieval.top_k(asked, corpus, 2).orderBy("rank").collect()] == [(1, 1), (3, 2)]
    assert rows(retrieval.top_k(asked, corpus, 2, block=1)) == rows(retrieval.top_k(asked, corpus, 2))
    assert [r["vec_id"] for r in retrieval.search(asked, corpus, 2, contains="X.PDF").orderBy("rank").collect()] == [3, 2]
    assert [r["vec_id"] for r in retrieval.search(asked, corpus, 1, contains="X.PDF", overfetch=1).collect()] == []
    assert retrieval.top_k(asked.where("false"), corpus, 2).count() == 0


def test_json_recovery_and_validation(spark):
    good = {"questions": [{"question": "How many ways?", "options": list("abcd"), "correct_answer": "a", "shortcut_used": "counting"}]}
    three = {"questions": [good["questions"][0] | {"options": list("abc")}]}
    wrong = {"questions": [good["questions"][0] | {"correct_answer": "z"}]}
    text = json.dumps(good)
    raws = [text, f"Sure!\n```json\n{text}\n```", f"Sure! {text} done", "nothing", json.dumps(three), json.dumps(wrong), '{"questions": []}', None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    q = df.withColumn("j", generation.recovered_json(F.col("raw"))).withColumn("q", F.from_json("j", generation.QUIZ))
    got = q.orderBy("i").select(F.col("j").isNotNull(), generation.valid_quiz(F.col("q"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (True, True), (True, True), (False, False), (True, False), (True, False), (True, True), (False, False)]


def test_requests_that_fail_are_rows(spark):
    def call(prompt: str) -> str:
        if prompt == "bad":
            raise RuntimeError("no")
        return prompt.upper()

    df = spark.createDataFrame([("a",), ("bad",)], "prompt string")
    assert rows(generation.ask(df, call)) == [("a", "A", None), ("bad", None, "RuntimeError: no")]


def test_ocr_budget_and_better_text(spark):
    df = spark.createDataFrame([(i, "f", i, "" if i % 2 else "x" * 50) for i in range(10)], "page_id int, file string, page int, text string")
    assert [(r["page_id"], r["covered"]) for r in quality.ocr_budget(df, "file", "page", "page_id", most=2).orderBy("page_id").collect()] == [(1, True), (3, True), (5, False), (7, False), (9, False)]
    both = spark.createDataFrame([("ab", "abc"), ("abc", "xyz"), (None, "x"), ("a", None)], "n string, o string")
    assert [r[0] for r in both.select(quality.better_text(F.col("n"), F.col("o"))).collect()] == ["abc", "abc", "x", "a"]


def test_histogram_keeps_empty_buckets(spark):
    df = spark.createDataFrame([(0,), (20,), (21,), (700,), (None,)], "n int")
    assert [tuple(r) for r in survey.page_histogram(df, "n").orderBy("bucket_no").collect()] == [(0, "0-20", 2, 20), (1, "21-50", 1, 21), (2, "51-100", 0, 0), (3, "101-300", 0, 0), (4, "301-600", 0, 0), (5, "601+", 1, 700)]


def test_remaining(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(incremental.remaining(a, b, "k")) == [(1,), (None,)]


def test_embeddings_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "b a")], "id int, text string")
    got = {r["id"]: r["embedding"] for r in embedding.embed(df, "id", "text").collect()}
    again = {r["id"]: r["embedding"] for r in embedding.embed(df, "id", "text", by_length=True).collect()}
    assert got == again and got[1] == got[4] and got[2] is None and set(got[3]) == {0.0}


def test_files_become_pages(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x.HTML").write_text("<html><script>no()</script><style>p{}</style><p>Tom &amp; Ann</p>\n\n\n\n<p>end</p></html>")
    word = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(tmp_path / "y.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{word}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>Body </w:t></w:r><w:r><w:t>text</w:t></w:r></w:p></w:body></w:document>')
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "z.pdf").write_bytes(b"%PDF")
    (tmp_path / "skip.txt").write_text("x")
    with zipfile.ZipFile(tmp_path / "pack.zip", "w") as z:
        z.writestr("d/one.PDF", "x")
        z.writestr("d/two.pdf", "x")
        z.writestr("plain", "x")
    (tmp_path / "bad.zip").write_bytes(b"x")
    got, errors = files.pages(spark, str(tmp_path))
    texts = {r["source_rel"]: r for r in got.collect()}
    assert texts["a b/x.HTML"]["text"].split() == ["Tom", "&", "Ann", "end"] and "\n\n\n" not in texts["a b/x.HTML"]["text"]
    assert texts["y.docx"]["text"] == "Head\nBody text" and texts["y.docx"]["spans"][0]["text"] == "Head"
    assert {r["source_rel"] for r in errors.collect()} == {"broken.docx", "z.pdf"}
    table = [["a", "b"], ["c", "d"]]
    pdf = lambda content: [(1, "one", "pdf", [], [table, [["x"]]]), (2, ValueError("torn")), (3, "three", "pdf", [], []), (4, "four", "pdf", [], [])]
    read, failed = files.pages(spark, str(tmp_path), {".pdf": pdf}, max_pages=3, every=True)
    assert {(r["page_num"], len(r["tables"])) for r in read.where("doc_type = 'pdf'").collect()} == {(1, 1), (3, 0)}
    assert {(r["source_rel"], r["page_num"]) for r in failed.collect()} == {("z.pdf", 2), ("broken.docx", None), ("skip.txt", None), ("pack.zip", None), ("bad.zip", None)}
    assert {(r["source_rel"], r["n_pages"]) for r in files.page_counts(read).collect()} >= {("z.pdf", 2)}
    kept = chunking.docx_lines(got)
    assert kept.where("doc_type = 'docx'").first()["spans"] == [] and chunking.docx_lines(got, drop_body=True) is got
    listed = files.listing(spark, str(tmp_path))
    assert {r["rel"] for r in files.supported(listed).collect()} == {"a b/x.HTML", "y.docx", "broken.docx", "z.pdf"}
    census = {(r["ext"], r["files"]) for r in files.archive_census(spark, str(tmp_path)).where("error IS NULL").collect()}
    assert census == {(".pdf", 2), ("(no ext)", 1)}


def test_spans_of_blocks(spark):
    part = "struct<text:string,size:double,flags:int>"
    data = [([{"type": 0, "lines": [{"parts": [{"text": "A", "size": 10.25, "flags": 16}, {"text": "b ", "size": 9.0, "flags": 0}], "bbox": [0.0]}, {"parts": [{"text": "  ", "size": 1.0, "flags": 0}], "bbox": [0.0]}]}, {"type": 1, "lines": []}],)]
    df = spark.createDataFrame(data, f"blocks array<struct<type:int,lines:array<struct<parts:array<{part}>,bbox:array<double>>>>>")
    assert [tuple(s)[:3] for s in files.spans_of(df).first()["spans"]] == [("Ab", 10.2, True)]


def test_stores(spark, tmp_path):
    links = spark.createDataFrame([("a\\b", "question", "c\\d", "m")], schemas.LINK)
    sinks.rebuild(links, str(tmp_path / "links"))
    assert rows(files.link_table(spark, str(tmp_path / "links")))[0][0] == "a/b"
    assert files.link_table(spark, str(tmp_path / "missing")).count() == 0
    vectors = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "chunk_id string, embedding array<float>")
    sinks.load_vectors(vectors.where("chunk_id = 'a'"), str(tmp_path / "v"))
    sinks.load_vectors(vectors, str(tmp_path / "v"), resume=True)
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2
    (tmp_path / "map.json").write_text(json.dumps({"a\\b": {"role": "question", "linked_to": "c\\d", "match_type": "m"}, "c\\d": {"role": "answer", "linked_to": "a\\b"}}, indent=2))
    assert rows(files.link_map(spark, str(tmp_path / "map.json"))) == [("a/b", "question", "c/d", "m"), ("c/d", "answer", "a/b", None)]
    (tmp_path / "eval.json").write_text(json.dumps({"_README": "x", "items": [{"id": "1", "section": "QA", "topic": "t", "question": "q", "must_contain_any": ["a"], "expected_source_any": []}]}))
    assert files.eval_set(spark, str(tmp_path / "eval.json")).first()["must_contain_any"] == ["a"]


def test_streamed_chunks_are_added_once(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "chunk_id string, text string").write.parquet(source)
    ingest_new(spark, source, target, check).awaitTermination(60)
    spark.createDataFrame([("b", "y"), ("c", "z")], "chunk_id string, text string").write.mode("append").parquet(source)
    ingest_new(spark, source, target, check).awaitTermination(60)
    assert rows(spark.read.parquet(target).select("chunk_id")) == [("a",), ("b",), ("c",)]


@pytest.mark.parametrize("ks", [(1, 3), (2,)])
def test_hit_rates(spark, ks):
    hits = spark.createDataFrame([("1", "A", 1, False, True), ("1", "A", 2, True, True), ("2", "B", 1, False, False)], "query_id string, section string, rank int, content_hit boolean, source_hit boolean")
    got = {(r["section"], r["k"]): (r["n"], r["content_hits"], r["source_hits"]) for r in retrieval.hit_rates(hits, "section", ks).collect()}
    assert got[("all", ks[-1])] == (2, 1, 1) and got[("A", ks[0])] == (1, int(ks[0] >= 2), 1)


def test_ocr_fallback(spark):
    def read(file: str, page: int) -> str:
        if page == 2:
            raise RuntimeError("no scan")
        return "r" * 60

    df = pages(spark, [("f", "pdf", 1, "", "pymupdf", [span("x")], [[["a"]]]), ("f", "pdf", 2, "", "pymupdf", [], []), ("f", "pdf", 3, "y" * 80, "pymupdf", [], []), ("f", "pdf", 4, None, "pymupdf", [], [])])
    got = {r["page_num"]: r for r in quality.ocr_fallback(df, read, most=2).collect()}
    assert got[1]["text"] == "r" * 60 and got[1]["method"] == "ocr" and got[1]["spans"] == [] and got[1]["tables"] == []
    assert got[2]["text"] == "" and "no scan" in got[2]["note"] and got[3]["note"] is None and got[4]["text"] == "r" * 60  # a failed reading is not charged
    last = {r["page_num"]: r for r in quality.ocr_fallback(df, read, most=1).collect()}
    assert last[1]["method"] == "ocr" and last[4]["text"] is None and "budget" in last[4]["note"] and "budget" in last[2]["note"]


def test_extraction_cache(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"path": "/x", "source_rel": "a.pdf", "doc_type": "pdf", "pages": [{"page_num": 1, "text": "t", "method": "pymupdf", "spans": [], "tables": []}], "errors": []}) + "\n{broken\n")
    good, broken = files.extractions(spark, str(tmp_path))
    assert [(r["source_rel"], r["page_num"], r["text"]) for r in good.collect()] == [("a.pdf", 1, "t")] and len(broken.collect()) == 1


def test_generation_and_judging(spark):
    quiz = {"questions": [{"question": "How many ways?", "options": list("abcd"), "correct_answer": "a", "shortcut_used": "alligation rule"}]}

    def call(prompt: str) -> str:
        if "Judge" in prompt:
            return 'So: {"answer_correct": true, "shortcut_grounded": true, "confidence": 0.9, "notes": ""}'
        if "broken" in prompt:
            raise TimeoutError("late")
        return json.dumps(quiz)

    df = spark.createDataFrame([("one", "the alligation rule"), ("broken", "text"), ("none", "")], "topic string, context string")
    made = generation.quizzes(df, call)
    assert {r["topic"]: (r["valid"], r["error"]) for r in made.collect()} == {"one": (True, None), "broken": (False, "TimeoutError: late"), "none": (False, "nothing was found")}
    told = generation.judged(made, call).collect()
    assert [(r["topic"], r["ok"], r["lexical"], r["distinct_options"]) for r in told] == [("one", True, 1.0, True)]
    answers = spark.createDataFrame([("a", "a"), ("b", "a"), (None, "a")], "chosen string, correct_answer string")
    assert sorted(r["is_right"] for r in generation.graded(answers).collect()) == [False, False, True]
    for bad in (("x", 3, 6), ("topic", 9, 6), ("topic", 3, 13)):
        with pytest.raises(ValueError):
            generation.check_request(*bad)


def test_patience_with_a_provider():
    waits, answers = [], iter([generation.Refused(429, "Please try again in 1.5s"), generation.Refused(503), "done"])

    def call(prompt: str) -> str:
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert generation.retried(call, sleep=waits.append)("p") == "done" and waits == [2.0, 2.0]
    tries = []

    def refused(prompt: str) -> str:
        tries.append(prompt)
        raise generation.Refused(500 if prompt == "busy" else 401)

    for prompt, n in (("busy", 5), ("key", 1)):
        tries.clear()
        with pytest.raises(generation.Refused):
            generation.retried(refused, sleep=waits.append)(prompt)
        assert len(tries) == n


def test_store_order_and_counters(spark):
    df = spark.createDataFrame([("f", 1, "d::text::2", "ok"), ("f", 1, "d::text::10", "ok"), ("e", None, "x", "error"), ("f", None, "d::text::1", None)], "source_file string, page_start int, chunk_id string, status string")
    assert [r["chunk_id"] for r in dedup.store_order(df).collect()] == ["x", "d::text::1", "d::text::10", "d::text::2"]
    rows_, counters = survey.observed(df)
    rows_.count()
    assert counters.get == {"rows": 4, "failed": 2}
