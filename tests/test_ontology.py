import random
import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from litquarry.functions import fuzzy
from litquarry.operators import ontology
from litquarry.plans.mart import gene_mart

TUMORS = [
    (0, "Lung Adenocarcinoma", "LUAD", "Non-Small Cell Lung Cancer"),
    (1, "melanoma", "MEL", "Melanoma"),
    (2, "sarcoma", "SARC", "melanoma"),
    (3, "melanoma", "MEL2", "sarcoma"),
    (4, "glioblastoma", "GBM", None),
    (5, "Breast Invasive Ductal Carcinoma", "IDC", "Breast Cancer"),
]


@pytest.fixture(scope="module")
def tumors(spark):
    return spark.createDataFrame(TUMORS, "ordinal int, name string, code string, mainType string")


def test_exact_match_prefers_earlier_tumour_and_its_name(spark, tumors):
    df = spark.createDataFrame([("melanoma",), ("sarcoma",), ("glioblastoma",), ("Melanoma",), ("",), ("x",)], "cleaned string")
    got = {r["cleaned"]: tuple(r["match"]) if r["match"] else None for r in ontology.match_exact(df, tumors).collect()}
    assert got == {
        "melanoma": ("melanoma", "MEL", "Melanoma"), "sarcoma": ("sarcoma", "SARC", "melanoma"),
        "glioblastoma": ("glioblastoma", "GBM", None), "Melanoma": ("NA", "NA", "Melanoma"), "": None, "x": None,
    }


def test_case_insensitive_option(spark, tumors):
    df = spark.createDataFrame([("breast cancer",)], "cleaned string")
    assert ontology.match_exact(df, tumors).first()["match"] is None
    assert ontology.match_exact(df, tumors, case_insensitive=True).first()["match"]["mainType"] == "Breast Cancer"


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("melanoma", "melanoma", 100),
        ("melanoma", "Melanoma!", 100),
        ("lung cancer", "cancer lung", 95),
        ("breast cancer", "breast cancers", 96),
        ("cancer", "non small cell lung cancer", 90),
        ("a", "b", 0),
        ("", "x", 0),
        ("x", "an abbreviation far longer than x", 60),
    ],
)
def test_weighted_ratio_golden_scores(a, b, score):
    assert fuzzy.weighted_ratio(fuzzy.normalise(a), fuzzy.normalise(b)) == score
    assert fuzzy.weighted_ratio(fuzzy.normalise(b), fuzzy.normalise(a)) == score


def random_names(seed, n):
    rng = random.Random(seed)
    words = ["lung", "breast", "cancer", "cell", "small", "non", "carcinoma", "sarcoma", "of", "the", "ductal", "x", "b"]

    def altered(word):
        at = rng.randrange(len(word))
        return word[:at] + rng.choice(["", "e", word[at] * 2]) + word[at + 1:] if rng.random() < 0.3 else word

    return [" ".join(altered(rng.choice(words)) for _ in range(rng.randrange(1, 6))) for _ in range(n)]


def brute_force(text, candidates, threshold, score):
    scored = [(score(text, c), -i) for i, c in enumerate(candidates)]
    best, at = max(scored)
    return (-at, best) if best > threshold else None


@pytest.mark.parametrize("threshold", [0, 50, 80, 95])
def test_bounds_never_hide_the_best_candidate(threshold):
    candidates = random_names(1, 80)
    index = fuzzy.Candidates(candidates)
    score = lambda a, b: fuzzy.weighted_ratio(fuzzy.normalise(a), fuzzy.normalise(b))
    texts = random_names(2, 150) + ["", "???", "lung", "lung  lung", "zzz"]
    assert [index.best(t, threshold) for t in texts] == [brute_force(t, candidates, threshold, score) for t in texts]


def as_ontology(spark, names):
    data = [(i, n, f"C{i}", None) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "ordinal int, name string, code string, mainType string")


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, previous = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("threshold", [50, 66, 80, 93])
def test_levenshtein_matches_equal_brute_force(spark, threshold):
    names, texts = random_names(3, 60), sorted(set(random_names(4, 120)) | {"a", "lung", "x"})
    df = spark.createDataFrame([(t,) for t in texts], "cleaned string")
    found = ontology.match_fuzzy(df, as_ontology(spark, names), threshold=threshold, method="levenshtein")
    got = {r["cleaned"]: (r["match"]["matched_name"], r["score"]) for r in found.collect()}
    score = lambda a, b: 100.0 * (1.0 - levenshtein(a, b) / max(len(a), len(b)))
    expected = {t: brute_force(t, names, threshold, score) for t in texts}
    assert got == {t: (names[hit[0]], hit[1]) for t, hit in expected.items() if hit}
    assert len(got) > 3


def test_score_of_exactly_the_threshold_is_no_match(spark):
    df = spark.createDataFrame([("abcdx",)], "cleaned string")
    assert ontology.match_fuzzy(df, as_ontology(spark, ["abcde"]), method="levenshtein").count() == 0
    assert ontology.match_fuzzy(df, as_ontology(spark, ["abcde"]), method="wratio").count() == 0


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    names = random_names(6, 90)
    df = spark.createDataFrame([(t,) for t in random_names(7, 80)], "cleaned string")
    whole = rows(ontology.match_fuzzy(df, as_ontology(spark, names), method="wratio"))
    score = lambda a, b: fuzzy.weighted_ratio(fuzzy.normalise(a), fuzzy.normalise(b))
    expected = {t: brute_force(t, names, 80, score) for t in {r[0] for r in df.collect()} if t}
    assert {r[0]: (r[2][0], r[1]) for r in whole} == {t: (names[h[0]], h[1]) for t, h in expected.items() if h}
    monkeypatch.setattr(ontology, "BLOCK", 13)
    assert rows(ontology.match_fuzzy(df, as_ontology(spark, names), method="wratio")) == whole


def test_names_are_compared_in_their_normal_form(spark):
    df = spark.createDataFrame([("nsclc lungs",), ("nonsmall cell lung cancers",)], "cleaned string")
    found = ontology.match_fuzzy(df, as_ontology(spark, ["NSCLC Lung", "Non-Small Cell Lung Cancer"]))
    assert {r["cleaned"]: r["match"]["matched_name"] for r in found.collect()} == {
        "nsclc lungs": "NSCLC Lung", "nonsmall cell lung cancers": "Non-Small Cell Lung Cancer",
    }


def test_a_common_ending_joins_few_pairs(spark):
    rng = random.Random(9)
    stem = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 14)))
    names = sorted({f"{stem()} carcinoma" for _ in range(96)})
    texts = sorted({f"{stem()} carcinoma" for _ in range(200)} | {n + "s" for n in names})
    df = spark.createDataFrame([(t,) for t in texts], "cleaned string")
    found = ontology.match_fuzzy(df, as_ontology(spark, names))
    assert {r["cleaned"]: r["match"]["matched_name"] for r in found.collect()}.items() >= {n + "s": n for n in names}.items()
    joined = compared_pairs(spark, df, names)
    assert joined < 0.1 * len(names) * len(texts)


def compared_pairs(spark, texts, names):
    """Pairs that come out of the segment join, by a score that lets all of them pass."""
    from unittest import mock

    candidates = ontology.match_candidates(as_ontology(spark, names)).select("text", ontology._place().alias("_place"))
    with mock.patch.object(ontology.fuzzy, "levenshtein_score", lambda left, right: F.lit(100.0)):
        return ontology._levenshtein_scores(texts, candidates, "cleaned", 80).count()


def test_no_text_is_sorted_to_aggregate(spark, tumors):
    df = spark.createDataFrame([("melanomas",)], "Disease string")
    assert "SortAggregate" not in plan_of(ontology.match_candidates(tumors))
    assert "SortAggregate" not in plan_of(ontology.map_indications(df, tumors))


def test_mapping_of_every_kind(spark, tumors):
    diseases = [None, "melanoma (stage 2), mets", "Melanomas", "---", "breast cancer", "qqqq"]
    df = spark.createDataFrame([(d,) for d in diseases * 2], "Disease string")
    got = {r["Disease"]: tuple(r)[1:] for r in ontology.map_indications(df, tumors).collect()}
    assert len(got) == len(diseases)
    nothing = (None, None, None)
    assert got[None] == got["---"] == got["qqqq"] == nothing
    assert got["melanoma (stage 2), mets"] == got["Melanomas"] == ("melanoma", "MEL", "Melanoma")
    assert got["breast cancer"] == ("NA", "NA", "Breast Cancer")


def test_gene_mart(spark, tumors):
    data = [
        ("1 a", "melanoma", '"A, B"'), ("2 b", "breast cancer", '["A"]'), ("3 c", "n/a", '"n/a"'), ("4 d", "zzz", '"A"'),
        ("5 e", "melanoma", "[]"), ("x f", None, '["n/a"]'),
    ]
    extractions = spark.createDataFrame(data, "abstract string, Disease string, g string").withColumn("Genes", F.parse_json("g"))
    groups = spark.createDataFrame([("Melanoma", "Skin")], "mainType string, top_group string")
    tables = gene_mart(extractions, tumors, groups, min_count=1)
    assert rows(tables["detail"]) == [
        ("1", "A", "melanoma", "Melanoma", "melanoma", "MEL", "Skin"),
        ("1", "B", "melanoma", "Melanoma", "melanoma", "MEL", "Skin"),
        ("2", "A", "breast cancer", "Breast Cancer", "Breast Cancer", "NA", "Other Cancer"),
        ("4", "A", "zzz", None, None, None, "Other Cancer"),
    ]
    assert [tuple(r) for r in tables["popular"].collect()] == [("A", 2), ("B", 1)]
    assert rows(tables["totals"]) == [("Breast Cancer", 1), ("Melanoma", 2)]
    assert rows(tables["most_common"]) == [("Melanoma", 2)]
    assert rows(tables["indications"]) == [("Breast Cancer", "breast cancer"), ("Melanoma", "melanoma")]
    assert rows(tables["main_types"]) == [("Breast Cancer",), ("Melanoma",), (None,)]
    assert tables["rows"].count() == 5
    assert not any(re.search("levenshtein|from_json|try_variant", plan_of(table)) for table in tables.values())


@pytest.mark.parametrize("threshold", [50, 70, 90])
def test_token_matches_equal_brute_force(spark, threshold):
    import random

    draw = random.Random(threshold)
    vocabulary = ["carcinoma", "cell", "small", "lung", "of", "non", "adeno", "b", "lymphoma", "large"]
    make = lambda: " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 5)))
    names = sorted({make() for _ in range(60)})
    texts = [make() for _ in range(80)] + [make() + "x" for _ in range(40)] + ["", " ", "unknown"]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    def score(a, b):
        x, y = set(a.split()), set(b.split())
        shared = 200 * sum(map(len, x & y)) / (sum(map(len, x)) + sum(map(len, y)))
        a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        return max(shared, 100 * (1 - edits(a, b) / max(len(a), len(b))))

    expected = {}
    for text in {t for t in texts if t.split()}:
        above = sorted((-score(text, n), i) for i, n in enumerate(names) if score(text, n) > threshold)
        expected |= {(text, rank): (names[i], pytest.approx(-s)) for rank, (s, i) in enumerate(above[:5], 1)}
    df = spark.createDataFrame([(t,) for t in texts], "cleaned string")
    found = ontology.best_candidates(df, as_ontology(spark, names), threshold=threshold, method="tokens").collect()
    assert {(r["cleaned"], r["rank"]): (r["match"]["matched_name"], r["score"]) for r in found} == expected
    best = ontology.match_fuzzy(df, as_ontology(spark, names), threshold=threshold, method="tokens").collect()
    assert {(r["cleaned"], 1): (r["match"]["matched_name"], r["score"]) for r in best} == {k: v for k, v in expected.items() if k[1] == 1}


def test_token_pairs_meet_in_rare_words_only(spark):
    from conftest import plan_of

    from litquarry.operators import token_match

    names = spark.createDataFrame([(f"kind{i} tumour",) for i in range(300)], "name string")
    texts = spark.createDataFrame([(f"tumour kind{i}",) for i in range(300)], "text string")
    pairs = token_match.token_set_pairs(texts, names, 80)
    plan = plan_of(pairs)
    assert pairs.count() == 300 and not any(n in plan for n in ("EvalPython", "InPandas", "NestedLoop", "Cartesian"))
