import contextlib
import hashlib
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from litquarry import schemas
from litquarry.operators.filters import literature_filter
from litquarry.session import materialize, scratch_path, scratch_tables, shared_folder
from litquarry.sources import sinks, tables
from litquarry.streaming import ingest


def test_match_files_need_the_suffix(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    (tmp_path / "a" / "notes.txt").write_text("x")
    assert tables.read_matches(spark, str(tmp_path / "a"), "id long").count() == 3
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "notes.txt").write_text("x")
    with pytest.raises(ValueError):
        tables.read_matches(spark, str(tmp_path / "empty"))


def test_union_skips_missing_files_but_not_wrong_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(2).toDF("other").write.parquet(str(tmp_path / "b"))
    assert tables.union_files(spark, [str(tmp_path / "a"), str(tmp_path / "none")]).count() == 2
    with pytest.raises(ValueError):
        tables.union_files(spark, [str(tmp_path / "none")])
    with pytest.raises(Exception, match="other"):
        tables.union_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count()


ARTICLES = """<?xml version="1.0"?>
<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">1</PMID><Article><ArticleTitle>first</ArticleTitle>
<Abstract><AbstractText>old</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID Version="1">2</PMID><Article><ArticleTitle>no abstract</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>3</PMID><Article><ArticleTitle>tags</ArticleTitle>
<Abstract><AbstractText>one <i>it</i> x</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID Version="2">1</PMID><Article><ArticleTitle>second &amp; last</ArticleTitle>
<Abstract><AbstractText Label="A">new</AbstractText><AbstractText>text</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>
"""


def test_pubmed_xml(spark, tmp_path):
    (tmp_path / "articles.xml").write_text(ARTICLES)
    assert rows(tables.read_pubmed_xml(spark, str(tmp_path / "articles.xml"))) == [
        ("1", "second & last", "new text"), ("2", "no abstract", "No abstract available"), ("3", "tags", "one <i>it</i> x"),
    ]


def test_ontology_keeps_its_order(spark, tmp_path):
    types = [{"name": n, "code": n[:2], "mainType": None, "level": 1} for n in ["zeta", "alpha", "mid"]]
    (tmp_path / "types.json").write_text(json.dumps(types, indent=1))
    assert rows(tables.read_ontology(spark, str(tmp_path / "types.json"))) == [
        (0, "zeta", "ze", None), (1, "alpha", "al", None), (2, "mid", "mi", None),
    ]


def test_extractions_from_an_array_and_from_lines(spark, tmp_path):
    found = [
        {"Disease": "x", "Genes": ["A", "B"], "abstract": "1 a"}, {"Disease": "n/a", "Genes": "A, B", "abstract": "2"},
        {"Genes": 5, "abstract": "3"},
    ]
    (tmp_path / "array.json").write_text(json.dumps(found, indent=4))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in found))
    one, two = (
        rows(tables.read_extractions(spark, str(tmp_path / name), lines).withColumn("Genes", F.to_json("Genes")))
        for name, lines in [("array.json", False), ("lines.json", True)]
    )
    assert one == two == [("1 a", "x", '["A","B"]', None), ("2", "n/a", '"A, B"', None), ("3", None, "5", None)]


def test_csv_round_trip(spark, tmp_path):
    data = [('a "q", b\nnext', "n/a", " pad "), ("x", None, ""), ("é\\", "d", "g")]
    df = spark.createDataFrame(data, schemas.SYNTHETIC)
    sinks.write_csv_table(df, str(tmp_path / "t"))
    got = rows(tables.read_csv_table(spark, str(tmp_path / "t"), schemas.SYNTHETIC))
    assert got == sorted([('a "q", b\nnext', None, " pad "), ("x", None, ""), ("é\\", "d", "g")], key=repr)


def test_jsonl_keeps_the_raw_line(spark, tmp_path):
    line = '{"messages": [{"role": "user", "content": "q", "extra": 1}], "functions": [{"a": 1}], "other": 2}'
    (tmp_path / "x.jsonl").write_text(line + "\n\n")
    (row,) = tables.read_jsonl(spark, str(tmp_path / "x.jsonl")).collect()
    assert row["raw"] == line and row["messages"][0]["content"] == "q" and row["functions"] == ['{"a":1}']


@pytest.mark.parametrize("n", [0, 1, 7, 25_000])
def test_json_arrays_are_read_back(spark, tmp_path, n):
    df = spark.range(n).repartition(5).selectExpr("concat('t', id) AS abstract", "CAST(NULL AS STRING) AS Disease", "parse_json('[1]') AS Genes")
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    with no_coalescing(spark):
        sinks.write_json_array(df, *paths)
    parts = [json.loads(p.read_text()) for p in sorted((tmp_path / "two").glob("part-*"))]
    assert sum(map(len, parts)) == n and (n < 100 or len([p for p in parts if p]) >= 4)
    for path in paths:
        got = tables.read_extractions(spark, path)
        assert sorted(r["abstract"] for r in got.collect()) == sorted(f"t{i}" for i in range(n))


@contextlib.contextmanager
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_splits_are_written_in_shuffled_order(spark, tmp_path):
    made = spark.range(3000).selectExpr(
        "id AS key", "CASE WHEN id % 3 = 0 THEN 'validation' ELSE 'train' END AS split",
        "array(named_struct('role', 'assistant', 'content', CAST(id AS STRING))) AS messages",
    )
    with no_coalescing(spark):
        sinks.export_splits(made, str(tmp_path / "out"), seed=5)
    for split, keys in (("validation", range(0, 3000, 3)), ("train", [i for i in range(3000) if i % 3])):
        lines = [line for p in sorted((tmp_path / "out" / f"split={split}").glob("part-*")) for line in p.read_text().splitlines()]
        order = sorted(keys, key=lambda i: hashlib.md5(f"5:{i}".encode()).hexdigest())
        assert [int(json.loads(line)["messages"][0]["content"]) for line in lines] == order
    assert tables.read_splits(spark, str(tmp_path / "out")).groupBy("split").count().count() == 2


def test_pages_from_text_files(spark, tmp_path):
    (tmp_path / "p1.txt").write_text("line 1\nline 2")
    assert [r["text"] for r in tables.read_pages(spark, str(tmp_path)).collect()] == ["line 1\nline 2"]


def write_matches(spark, folder, name, pmid):
    df = spark.createDataFrame([(pmid, "t", "k", "DS", ["h"], "abstract"), (pmid, "t", "k", "XX", ["h"], "abstract")], schemas.MATCHES)
    df.coalesce(1).write.parquet(str(folder / f"tmp-{name}"))
    (part,) = (folder / f"tmp-{name}").glob("part-*")
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / f"{name}.parquet").write_bytes(part.read_bytes())


def test_ingest_processes_each_file_once(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "out", "progress")]
    for name in "abc":
        write_matches(spark, tmp_path, name, name)
    (tmp_path / "in" / "notes.txt").write_text("x")
    assert rows(ingest.ingest_new_files(spark, *paths).select("pmid")) == [("a",), ("b",), ("c",)]
    assert ingest.ingest_new_files(spark, *paths).count() == 3
    write_matches(spark, tmp_path, "d", "d")
    assert rows(ingest.ingest_new_files(spark, *paths).select("pmid")) == [("a",), ("b",), ("c",), ("d",)]


def test_ingest_totals_of_runs(spark, tmp_path):
    paths, totals = [str(tmp_path / p) for p in ("in", "out", "progress")], str(tmp_path / "totals")
    assert rows(ingest.ingest_totals(spark, totals)) == [(0, 0, 0)]
    for names in ("ab", "", "cde"):
        for name in names:
            write_matches(spark, tmp_path, name, name)
        ingest.ingest_new_files(spark, *paths, files_per_batch=2, totals=totals)
    assert rows(ingest.ingest_totals(spark, totals)) == [(5, 10, 5)]
    saved = spark.read.parquet(totals)
    assert sorted(rows(saved)) == [(0, 2, 4, 2), (1, 2, 4, 2), (2, 1, 2, 1)]
    saved.filter("batch = 1").write.mode("append").parquet(totals)  # a batch repeated after a lost run
    assert rows(ingest.ingest_totals(spark, totals)) == [(5, 10, 5)]


def test_section_is_tested_file_by_file(spark, tmp_path):
    bare = spark.createDataFrame([("1", "t", "k", "DS", ["h"])], "pmid string, text string, keywordId string, type string, organisms array<string>")
    for order in ("ab", "ba"):
        folder = tmp_path / order
        full = spark.createDataFrame([("2", "t", "k", "DS", ["h"], "body"), ("9", "t", "k", "DS", ["h"], "abstract"), ("3", "t", "k", "DS", ["h"], None)], schemas.MATCHES)
        for name, df in zip(order, (bare, full)):
            df.coalesce(1).write.parquet(str(folder / f"made-{name}"))
            (part,) = (folder / f"made-{name}").glob("part-*")
            (folder / "both").mkdir(exist_ok=True)
            (folder / "both" / f"{name}.parquet").write_bytes(part.read_bytes())
        read = literature_filter(tables.read_matches(spark, str(folder / "both")))
        stream = ingest.ingest_new_files(spark, *(str(folder / p) for p in ("both", "out", "progress")))
        for found in (read, stream):
            assert sorted(r["pmid"] for r in found.collect()) == ["1", "9"]


def test_ingest_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    found = ingest.ingest_new_files(spark, *(str(tmp_path / p) for p in ("in", "out", "progress")))
    assert found.columns == ["pmid", "text", "keywordId", "type", "organisms"] and found.count() == 0


def test_tables_of_a_flow_can_be_removed(spark):
    with scratch_tables(spark):
        df = materialize(spark.range(5), "x")
        (file, *_) = df.inputFiles()
        assert df.count() == 5
    assert not os.path.exists(file.removeprefix("file://"))


def test_written_tables_go_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert scratch_path(spark, "x").startswith(folder)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or configured.rstrip("/") == folder
    df = materialize(spark.range(5), "x")
    assert df.count() == 5 and all(f.split("://")[-1].removeprefix("file:").startswith(folder) for f in df.inputFiles())


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})


def test_only_a_local_session_gets_a_folder_of_its_own():
    assert shared_folder(_Session("local[2]")) == shared_folder(_Session("local[*]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))


def test_answers_are_saved_and_not_asked_again(spark, tmp_path):
    src, out, progress, log = (str(tmp_path / p) for p in ("in", "out", "progress", "log"))

    def fn(prompt):
        with open(log, "a") as file:
            file.write(prompt + "\n")
        if prompt == "p3":
            raise RuntimeError
        return prompt.upper()

    schema = "id bigint, prompt string"
    for numbers in ([1, 2], [3]):
        spark.createDataFrame([(i, f"p{i}") for i in numbers], schema).write.mode("append").parquet(src)
        got = ingest.answer_new_prompts(spark, src, out, progress, fn, schema)
    assert rows(got) == [(1, "p1", "P1"), (2, "p2", "P2"), (3, "p3", "Error querying model")]
    with open(log) as file:
        assert sorted(file.read().split()) == ["p1", "p2", "p3"]


@pytest.mark.parametrize("layout, written", [("lines", None), (4, 4), (1, 1)])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, layout, written):
    import json

    rows = [{"name": f"n}},\n{{ {i}]" if i % 7 == 0 else f"n{i}", "code": ["x", None][i % 2], "mainType": "m [a, b],"} for i in range(500)]
    path = tmp_path / "array.json"
    if written:
        path.write_text(json.dumps(rows, indent=written))
    else:
        path.write_text("[" + ",\n".join(map(json.dumps, rows)) + "]\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        parts = tables.read_json_array(spark, str(path), "name string, code string, mainType string", layout)
        assert parts.rdd.getNumPartitions() > 5
        found = tables.read_ontology(spark, str(path), layout).orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["ordinal"] for r in found] == list(range(500))
    assert [r.asDict() for r in found] == [{"ordinal": i, **r} for i, r in enumerate(rows)]


@pytest.mark.parametrize("layout, text, n", [("lines", "[]", 0), (4, "[]", 0), ("lines", '[\n{"name": "a"}\n]', 1), (4, '[\n    {\n        "name": "a"\n    }\n]', 1)])
def test_small_arrays(spark, tmp_path, layout, text, n):
    (tmp_path / "array.json").write_text(text)
    assert tables.read_ontology(spark, str(tmp_path / "array.json"), layout).count() == n


def test_an_element_that_is_no_object_is_an_error(spark, tmp_path):
    (tmp_path / "array.json").write_text('[{"name": "a"},\n{"name": }]')
    with pytest.raises(Exception, match="no JSON object"):
        tables.read_ontology(spark, str(tmp_path / "array.json"), "lines").collect()


def test_shuffled_lines_are_rendered_once_and_in_order(spark, tmp_path):
    from conftest import plan_of

    messages = "array(named_struct('role', 'user', 'content', 'text ' || id)) AS messages"
    samples = spark.range(500).selectExpr("id AS doc_id", messages, "if(id % 5 = 0, 'a', 'b') AS split")
    lines = sinks._shuffled_lines(samples, "doc_id", 123, ["split"], "messages")
    assert "rangepartitioning" not in plan_of(lines)  # a range sort renders all lines to sample them
    path = str(tmp_path / "splits")
    sinks.export_splits(samples, path, "doc_id")
    for split in "ab":
        files = sorted((tmp_path / "splits" / f"split={split}").glob("part-*"))
        texts = [json.loads(line)["messages"][0]["content"] for f in files for line in f.read_text().splitlines()]
        wanted = [i for i in range(500) if (i % 5 == 0) == (split == "a")]
        wanted.sort(key=lambda i: hashlib.md5(f"123:{i}".encode()).hexdigest())
        assert texts == [f"text {i}" for i in wanted]
