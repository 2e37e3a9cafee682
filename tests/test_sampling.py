import random
from collections import Counter

import pytest
from conftest import plan_of, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from litquarry.functions.hashing import hash_number, seeded_hash
from litquarry.operators import sampling


@pytest.fixture(scope="module")
def strata(spark):
    """A stratum with a third of all rows, some middling ones, many of one row, and nulls."""
    rng = random.Random(5)
    labels = ["hot"] * 2000 + [f"m{rng.randrange(20)}" for _ in range(3000)] + [f"s{i}" for i in range(900)] + [None] * 100
    data = [(i, label) for i, label in enumerate(labels)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, label string").repartition(7).cache()


def ordered_rows(spark, df, seed):
    got = df.select("id", "label", seeded_hash(seed, "id").alias("h")).collect()
    return [(r["id"], r["label"]) for r in sorted(got, key=lambda r: (r["h"], r["id"]))]


def test_ranks_are_a_permutation_in_seeded_order(spark, strata):
    ranked = {r["rank"]: r["id"] for r in sampling.global_rank(strata, "id", 11).collect()}
    assert [ranked[i + 1] for i in range(len(ranked))] == [i for i, _ in ordered_rows(spark, strata, 11)]


@pytest.mark.parametrize("n", [0, 1, 37, 5999, 6000, 10**9])
def test_take_first(spark, strata, n):
    assert sorted(r[0] for r in sampling.take_first(strata, n, "id", 3).collect()) == sorted(
        i for i, _ in ordered_rows(spark, strata, 3)[:n]
    )


def test_cap_per_group(spark, strata):
    expected, seen = [], Counter()
    for i, label in ordered_rows(spark, strata, 123):
        seen[label] += 1
        if seen[label] <= 50:
            expected.append((i, label))
    assert rows(sampling.cap_per_group(strata, "label", 50, "id")) == sorted(expected, key=repr)


@pytest.mark.parametrize("target", [1, 500, 1003, 6000, 7000])
def test_stratified_sample(spark, strata, target):
    ordered = ordered_rows(spark, strata, 123)
    sizes = Counter(label for _, label in ordered)
    quota = {label: min(int(size * (target / 6000)), size) for label, size in sizes.items()}
    picked, rest = [], []
    for i, label in ordered:
        if quota[label] > 0:
            quota[label] -= 1
            picked.append((i, label))
        else:
            rest.append((i, label))
    expected = picked + rest[: target - len(picked)]
    got = rows(sampling.stratified_sample(strata, "label", target, "id"))
    assert got == sorted(expected, key=repr)
    assert len(got) == min(target, 6000)


def test_batches_are_full(strata):
    sizes = Counter(r["batch"] for r in sampling.assign_batches(strata, 700, "id").collect())
    assert sizes == {**{b: 700 for b in range(8)}, 8: 400}


@settings(max_examples=8, deadline=None)
@given(n=st.integers(0, 400), frac=st.floats(0, 1), seed=st.integers(0, 5))
def test_split_is_exact(spark, n, frac, seed):
    split = sampling.train_val_split(spark.range(n), "id", frac, seed)
    sides = Counter(r["split"] for r in split.collect())
    assert sides["train"] == int(frac * n)
    assert sides.total() == n


def test_same_seed_same_rows_for_any_partitioning(spark, strata):
    first = rows(sampling.stratified_sample(strata, "label", 700, "id"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = rows(sampling.stratified_sample(strata.repartition(2, "label"), "label", 700, "id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == again
    assert first != rows(sampling.stratified_sample(strata, "label", 700, "id", seed=9))


def test_copies_are_numbered_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_CHUNK", 4)
    df = spark.createDataFrame([("a",)] * 11 + [("b",)] * 4 + [(None,)] * 3, "x string")
    assert rows(sampling.number_copies(df)) == sorted(
        [("a", i) for i in range(1, 12)] + [("b", i) for i in range(1, 5)] + [(None, i) for i in range(1, 4)], key=repr
    )


def test_mix_takes_from_both(spark):
    real = spark.range(50).selectExpr("concat('r', id) AS key", "'real' AS origin")
    synthetic = spark.range(20).selectExpr("concat('s', id) AS key", "'synthetic' AS origin")
    mixed = Counter(r["origin"] for r in sampling.mix_corpora(real, synthetic, 30, 100).collect())
    assert mixed == {"real": 30, "synthetic": 20}


def test_null_key_is_not_lost(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "id bigint")
    assert sampling.take_first(df, 3, "id").count() == 3
    assert sampling.global_rank(df, "id").count() == 3


def test_hash_number_range(spark):
    values = [r[0] for r in spark.range(500).select(hash_number(seeded_hash(1, "id"))).collect()]
    assert 0 <= min(values) and max(values) < 2**32 and len(set(values)) == 500


@pytest.mark.parametrize("digits", [1, 2])
def test_cuts_do_not_depend_on_the_size_of_buckets(spark, strata, monkeypatch, digits):
    keys = spark.range(700).selectExpr("CAST(id AS STRING) AS key")
    ordered = [r["key"] for r in sampling.seeded_order(keys, "key", 3).collect()]
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", digits)
    monkeypatch.setattr(sampling, "RANK_DIGITS", digits)
    for n in (0, 1, 350, 699, 700, 900):
        assert sorted(r["key"] for r in sampling.take_first(keys, n, "key", 3).collect()) == sorted(ordered[:n])
    split = sampling.train_val_split(keys, "key", 0.95, 3)
    assert sorted(r["key"] for r in split.filter("split = 'train'").collect()) == sorted(ordered[:665])
    ranked = {r["key"]: r["rank"] for r in sampling.global_rank(keys, "key", 3).collect()}
    assert [ranked[k] for k in ordered] == list(range(1, 701))


def test_cap_reads_its_input_once(spark, tmp_path):
    spark.range(100).selectExpr("CAST(id AS STRING) AS pmid", "id % 3 AS g").write.parquet(str(tmp_path / "t"))
    plan = plan_of(sampling.cap_per_group(spark.read.parquet(str(tmp_path / "t")), "g", 5))
    assert plan.count("Scan parquet") == 2 and "WindowGroupLimit" in plan  # once in the tree, once in its details
