"""Vector codes against plain search and the contract's rounds in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from litquarry.llm import vector_codes as vc


@pytest.mark.parametrize("spread", [3, 60, 5_000, 1 << 27])
@pytest.mark.parametrize("entries", [0, 1, 8, 9, 256])
def test_tree_finds_the_nearest_and_the_lowest_of_equals(spread, entries):
    draw = np.random.default_rng(entries + spread)
    book = draw.integers(-spread, spread + 1, (entries, 3))
    rows = np.concatenate([draw.integers(-spread, spread + 1, (400, 3)), book])
    tree = vc.Gnat(book)
    code, square = tree.nearest(rows)
    for row, c, s in zip(rows.tolist(), code.tolist(), square.tolist()):
        expected = min(((sum((x - y) ** 2 for x, y in zip(row, e)), i) for i, e in enumerate(book.tolist())), default=None)
        assert expected is None or (s, c) == expected


def test_tree_leaves_most_entries_out():
    draw = np.random.default_rng(1)
    centres = draw.integers(-2_000, 2_000, (16, 8))
    book = np.repeat(centres, 16, 0) + draw.integers(-40, 40, (256, 8))
    tree = vc.Gnat(book)
    tree.nearest(book[draw.integers(0, 256, 1_000)] + draw.integers(-40, 40, (1_000, 8)))
    assert tree.compared < 0.4 * 1_000 * 256


def plain(rows):
    """The contract, row by row; rows of (vec_id, vector, label) with equal lengths that 4 divides."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    size = len(kept[0][1]) // 4
    vectors = [[[math.floor(1024 * x) for x in r[1]][p * size:(p + 1) * size] for p in range(4)] for r in kept]
    books = [[v[p] for v in vectors[:256]] for p in range(4)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            members = {}
            for v in vectors:
                members.setdefault(nearest(p, v[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(c) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[p])]
    final = [[nearest(p, v[p]) for p in range(4)] for v in vectors]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{i:02x}" for _, i in f), sum(s for s, _ in f), r[2]) for r, f in zip(kept, final)]
    totals = {}
    for r in out:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    return sorted((str(r[0]), r[1], r[2], totals[r[3]], sha) for r in out)


@pytest.mark.parametrize("count", [5, 400])
def test_query_against_the_plain_contract(spark, count):
    draw = random.Random(count)
    rows = [(i, [draw.choice([0.0, 0.001, -0.37, draw.gauss(0, 1)]) for _ in range(8)], draw.choice([None, 1, 2])) for i in range(count)]
    rows += [(3, rows[2][1], 2), (3, rows[2][1], 2), (None, rows[1][1], None), (-7, [1.0] * 8, 1)]
    rows += [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("nan")] * 8, 1), (903, [1.0] * 7 + [float("-inf")], None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    as_read = [tuple(r) for r in vectors.collect()]
    for name in ("components", "code", "of", "entry", "a.b"):
        vectors = vectors.withColumn(name, F.lit("clash"))
    assert sorted((str(r[0]), *r[1:]) for r in vc.compressed(vectors).collect()) == plain(as_read)


def test_odd_lengths_huge_components_and_no_rows(spark):
    rows = [(1, [0.5, 1.0, 2.0], 1), (2, [], 1), (3, [3e38, -3e38, 1e9, 0.0, 0.25], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: r for r in vc.compressed(vectors).collect()}
    assert sorted(found) == [1, 2, 3] and all(r["error"] == 0 and len(r["code"]) == 8 for r in found.values())
    assert vc.compressed(vectors.limit(0)).collect() == []
    none = spark.createDataFrame([(1, None, 1), (2, [None], 2)], vectors.schema)
    assert vc.compressed(none).collect() == []
    assert vc.compressed(spark.createDataFrame([(4, [], 1)], vectors.schema)).first()["code"] == "00000000"


def test_reconstruction(spark):
    vectors = spark.createDataFrame([(1, [0.5, 0.25, -1.0, 2.0], 1), (2, [0.0, 0.0, 0.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    kept = vc._kept(vectors)
    books = vc.fit(kept)
    back = {r["vec_id"]: r["again"] for r in vc.reconstructed(vc._coded(kept, books), books, "again").collect()}
    assert np.abs(np.array(back[1]) - [0.5, 0.25, -1.0, 2.0]).max() < 0.001
