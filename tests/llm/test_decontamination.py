"""Decontamination against a plain search for every window."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from litquarry.llm import decontamination as dc


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, items, window=10):
    found = plain_words(text)
    hit, names = set(), set()
    for name, item in items:
        words = plain_words(item)
        k = min(len(words), window)
        for low in range(len(words) - k + 1 if k else 0):
            for at in range(len(found) - k + 1):
                if found[at:at + k] == words[low:low + k]:
                    hit |= set(range(at, at + k))
                    names.add("" if name is None else str(name))
    return len(found), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_automaton_finds_all_windows():
    draw = random.Random(1)
    for _ in range(300):
        window = draw.randint(1, 5)
        make = lambda n: " ".join(draw.choice("abc") for _ in range(draw.randint(0, n)))
        items = [(str(i), make(9)) for i in range(draw.randint(0, 6))]
        model = dc.Automaton([(n, dc.normalised(t).split()) for n, t in items], window)
        for _ in range(5):
            text = make(25)
            spans, names = model.hits(dc.normalised(text).split())
            expected = plain(text, items, window)
            assert (sum(b - a for a, b in spans), len(names)) == expected[1:3]
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
            assert hashlib.sha256(",".join(sorted(names)).encode()).hexdigest() == expected[3]


@pytest.fixture(scope="module")
def case():
    draw = random.Random(2)
    vocabulary = ["Alpha", "beta", "gamma", "delta9", "é", "ÀB", "zeta", "漢字", "eta", "theta"]
    make = lambda n: draw.choice([" ", "-", "\n", "_"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, make(draw.choice([0, 3, 8, 10, 14, 60]))) for i in range(25)]
    items += [(3, items[4][1]), (None, make(12)), (90, None), (91, ""), (92, "?!"), (93, items[5][1]), (94, "single")]
    texts = [make(40) for _ in range(20)]
    texts += [f"{make(20)} {t} {make(20)}" for _, t in items if t] + [None, "", " .. ", "SINGLE", "x" * 100_000, items[2][1], make(5_000)]
    docs = list(enumerate(texts)) + [(2, texts[2]), (2, texts[30]), (None, texts[31])]
    return items, docs


@pytest.mark.parametrize("words", [500_000, 60])
def test_query_against_plain_search(spark, monkeypatch, case, words):
    items, docs = case
    monkeypatch.setattr(dc, "GROUP_WORDS", words)
    monkeypatch.setattr(dc, "PIECE_WORDS", 1_000 if words > 1_000 else 12)
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("row", "found", "none", "k1", "a.b"):
        made = made.withColumn(name, F.lit(1))
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    rows = dc.contamination(made, tests).collect()
    expected = sorted((str(i), *plain(t, items)) for i, t in docs)
    assert sorted((str(r[0]), *r[1:]) for r in rows) == expected
    assert dc.contamination(made.limit(0), tests).collect() == []
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in dc.contamination(made, tests.limit(0)).collect())


@pytest.mark.parametrize("words", [500_000, 20])
def test_spans_are_cut_out(spark, monkeypatch, words):
    monkeypatch.setattr(dc, "GROUP_WORDS", words)
    item = "one two three four five six seven eight nine ten eleven"
    rows = [
        (1, "Before it, é. " + item.upper() + "! After it there are many more words to keep here.", 5),
        (2, item, 6), (3, None, None), (4, "", 0), (5, "nothing of it", 13),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("found", F.lit("x")).withColumn("a.b", F.lit("y"))
    items = spark.createDataFrame([(1, item), (2, "some other item of ten words that is in no document")], "item_id long, text string")
    out = dc.decontaminate(docs, items)
    assert out.columns == docs.columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert {i: r["text"] for i, r in kept.items()} == {
        1: "Before it, é. ! After it there are many more words to keep here.", 3: None, 4: "", 5: "nothing of it",
    }
    assert kept[1]["n_chars"] == len(kept[1]["text"]) and kept[5]["n_chars"] == 13 and kept[3]["n_chars"] is None
    assert all(r["found"] == "x" and r["a.b"] == "y" for r in kept.values())
