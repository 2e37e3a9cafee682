import json
import random

import pytest
from conftest import rows

from litquarry import schemas
from litquarry.functions.templates import EXTRACTION_PROMPT, GENERAL_TOPICS, NEGATIVE_SYSTEM
from litquarry.operators import synthesis
from litquarry.operators.filters import species_filter
from litquarry.plans import corpus
from litquarry.operators.extraction import split_at_headers
from litquarry.plans.extraction import answer_pages, extract_and_reject, extract_from_pages
from litquarry.plans.mart import gene_mart
from litquarry.plans.training import build_training_set


@pytest.fixture(scope="module")
def raw(spark):
    """Matches where one pmid holds a third of all rows, and dimensions with repeats and nulls."""
    rng = random.Random(3)
    organisms = [["human"], ["mice", "Humans"], ["mice"], [], None, ["rat", None, "man"]]
    data = []
    for _ in range(3000):
        pmid = "hot" if rng.random() < 0.34 else rng.choice([None] + [str(i) for i in range(150)])
        kind = rng.choice(["DS", "GP", "CD", None])
        key = f"EFO_{rng.randrange(40)}" if kind == "DS" else f"ENSG{rng.randrange(40)}"
        data.append((pmid, "t", key, kind, rng.choice(organisms), rng.choice(["abstract", "abstract", "title", None])))
    area = "MONDO_0045024"
    diseases = [(f"EFO_{i}", None if i == 7 else f"disease {i % 9}", [area] * (1 + i % 2) + ["x"]) for i in range(20)]
    diseases += [("EFO_3", "second name", [area]), ("EFO_21", "cancer", [area]), ("EFO_22", "asthma", ["x"])]
    symbols = [(f"ENSG{i}", f"G{i % 15}") for i in range(25)] + [("ENSG1", "ALIAS")]
    pubmed = [(str(i), f"title {i}", f"abstract {i}") for i in range(0, 150, 2)]
    return (
        spark.createDataFrame(data, schemas.MATCHES),
        spark.createDataFrame(diseases, schemas.DISEASES),
        spark.createDataFrame(symbols, schemas.GENE_SYMBOLS),
        spark.createDataFrame(pubmed, "pmid string, title string, abstract string"),
    )


def filtered(raw):
    return corpus.literature_filter(raw[0]), corpus.disease_area_filter(raw[1]), raw[2]


def test_one_pass_evidence_equals_the_joined_roll_ups(raw):
    parts = filtered(raw)
    one_pass = rows(corpus.labelled_pmids(*parts))
    assert one_pass == rows(species_filter(corpus.combined_evidence(*parts)))
    assert len(one_pass) > 20 and "hot" in {r[0] for r in one_pass}


def test_corpus_has_the_target_size(raw):
    labelled = corpus.labelled_pmids(*filtered(raw)).count()
    for target in (10, labelled + 50):
        built = corpus.build_corpus(*raw, target=target).collect()
        assert len(built) == min(target, labelled) == len({r["pmid"] for r in built})
        assert all((r["abstract"] == f"abstract {r['pmid']}") or (r["abstract"] is None) for r in built)


def test_training_set(spark):
    labelled = spark.createDataFrame(
        [(str(i), f"abstract {i}" if i % 10 else " ", None if i % 3 else "d", "G1") for i in range(100)],
        "pmid string, abstract string, disease_name string, gene string",
    )
    negatives = spark.createDataFrame([("same", "n/a", None)] * 5 + [(f"n{i}", "d", "n/a") for i in range(25)], schemas.SYNTHETIC)
    built = build_training_set(labelled, negatives, EXTRACTION_PROMPT, n_real=60, n_synth=28).collect()
    assert len(built) == 88 == len({r["key"] for r in built})
    assert sum(r["split"] == "train" for r in built) == int(0.95 * 88)
    assert sum(r["origin"] == "real" for r in built) == 60
    for r in built:
        question, answer = r["messages"]
        assert question["role"] == "user" and set(json.loads(answer["content"])) == {"Disease", "Genes"}
    everything = build_training_set(labelled, negatives, EXTRACTION_PROMPT)
    assert everything.count() == 90 + 30
    again = build_training_set(labelled.repartition(7), negatives, EXTRACTION_PROMPT, n_real=60, n_synth=28)
    assert rows(again.select("key", "split")) == sorted(((r["key"], r["split"]) for r in built), key=repr)


def test_pages_to_extractions(spark):
    pages = spark.createDataFrame(
        [("d", 0, "intro 123 Poster Session A 456 Oral Abstract Session BAD"), ("d", 1, "789 Poster Session fail"), ("d", 2, "none")],
        "doc_id string, page_no int, text string",
    )

    def fn(prompt):
        if "fail" in prompt:
            raise RuntimeError
        return "no json" if "BAD" in prompt else '{"Disease": "x", "Genes": ["A"]}'

    got = extract_from_pages(pages, "Read: [[[abstract]]]", fn).selectExpr("abstract", "Disease", "to_json(Genes)")
    assert rows(got) == [("123 Poster Session A", "x", '["A"]')]


def test_every_prompt_is_asked_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def fn(prompt):
        with open(log, "a") as file:
            file.write(prompt + "\n")
        return "no json" if "BAD" in prompt else '{"Disease": "melanoma", "Genes": ["A", "B"]}'

    pages = spark.createDataFrame([("d", i, f"12{i} Poster Session {'BAD' if i % 4 == 0 else 'A'}") for i in range(10)], "doc_id string, page_no int, text string")
    parsed, rejected = extract_and_reject(answer_pages(pages, "[[[abstract]]]", fn))
    tumors = spark.createDataFrame([(0, "melanoma", "MEL", "Skin")], "ordinal int, name string, code string, mainType string")
    tables = gene_mart(parsed, tumors, spark.createDataFrame([], "mainType string, top_group string"))
    assert (parsed.count(), rejected.count()) == (7, 3)
    assert all(table.collect() is not None for table in tables.values())
    with open(log) as file:
        assert sorted(file.read().splitlines()) == sorted(r["text"] for r in pages.collect())


def test_pieces_across_pages(spark):
    pages = spark.createDataFrame(
        [("d", 0, "intro 123 Poster Session A"), ("d", 1, "tail of A 456 Oral Abstract Session B"), ("d", 2, "more B"), ("d", 3, "end 789 Poster Session C"),
         ("e", 0, "no header"), ("e", 1, "nor here"), ("f", 5, "111 Poster Session X"), (None, 0, "222 Poster Session Y")],
        "doc_id string, page_no int, text string",
    )
    assert rows(split_at_headers(pages, across_pages=True)) == sorted([
        ("d", 0, "123 Poster Session A\ntail of A"), ("d", 1, "456 Oral Abstract Session B\nmore B\nend"), ("d", 2, "789 Poster Session C"),
        ("f", 0, "111 Poster Session X"), (None, 0, "222 Poster Session Y"),
    ], key=repr)


def test_negative_plan(spark):
    topics = spark.createDataFrame([(f"cancer {i}",) for i in range(7)] + [("cancer 0",)], "cancer_type string")
    ids = spark.range(2000)
    plan = synthesis.plan_negatives(ids, topics).collect()
    share = sum(r["is_cancer"] for r in plan) / 2000
    assert 0.77 < share < 0.83
    assert {r["topic"] for r in plan} == {f"cancer {i}" for i in range(7)} | set(GENERAL_TOPICS)
    assert all(r["genes"] == "n/a" and r["disease"] == (r["topic"] if r["is_cancer"] else "n/a") for r in plan)

    first = synthesis.plan_negatives(ids, topics, n=300)
    rest = synthesis.plan_negatives(ids, topics, existing=first)
    assert first.count() == 300
    assert sorted(map(tuple, first.collect() + rest.collect())) == sorted(map(tuple, plan))

    rendered = synthesis.render_negative_prompt(first).collect()
    for r in rendered:
        system, prompt = r["messages"]
        assert system["content"] == NEGATIVE_SYSTEM and f"related to {r['topic']}. " in prompt["content"]
        assert ("for this cancer type" in prompt["content"]) == r["is_cancer"]
