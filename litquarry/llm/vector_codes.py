"""Product codes of vectors, the nearest codebook entries found by geometric near-neighbour access trees."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litquarry.llm.alike import sized
from litquarry.llm.common import worker_model
from litquarry.llm.registry import query
from litquarry.session import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
SPLITS = 8
"""Split points of a node; a node of no more entries than this compares them all."""
SLACK = 2.0**-48
"""Relative widening of every distance, more than the rounding of its square root and of a sum."""

Codebooks = list[np.ndarray]


@dataclass
class Node:
    """Split points (entry numbers), for each pair of split point and child the least and largest distance, and the children."""

    splits: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: list["Node | None"] = field(default_factory=list)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a``, rows, to all of ``b``, columns, as exact integers."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * largest**2 * max(1, a.shape[1]) < 1 << 53:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in b], 1) if len(b) else np.zeros((len(a), 0), np.int64)


class Gnat:
    """Tree over the entries of a codebook.

    An entry belongs to the split point nearest to it, and a node keeps, for each of its split
    points, the range of distances from it to the entries of each child.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries))) if len(entries) else None
        self.compared = 0

    def _node(self, ids: np.ndarray) -> Node:
        if len(ids) <= SPLITS:
            return Node(ids)
        places = self._spread(ids)
        splits = ids[places]
        distance = np.sqrt(squares(self.entries[splits], self.entries[ids]).astype(np.float64))
        nearest = distance.argmin(0)
        nearest[places] = np.arange(len(places))
        node = Node(splits, np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2))
        for child in range(len(splits)):
            inside = nearest == child
            node.low[:, child] = distance[:, inside].min(1) * (1 - SLACK)
            node.high[:, child] = distance[:, inside].max(1) * (1 + SLACK)
            inside[places[child]] = False
            node.children.append(self._node(ids[inside]) if inside.any() else None)
        return node

    def _spread(self, ids: np.ndarray) -> np.ndarray:
        """Places of SPLITS entries, each the farthest from those chosen before it."""
        chosen = [0]
        least = squares(self.entries[ids[:1]], self.entries[ids])[0]
        least[0] = -1
        while len(chosen) < SPLITS:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, squares(self.entries[ids[chosen[-1:]]], self.entries[ids])[0])
            least[chosen] = -1
        return np.array(chosen)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each row's nearest entry, the lowest of equal ones, and its squared distance.

        All rows go down together. A child is left out for a row only where its distances to a
        split point lie strictly outside the row's distance to it, widened by the best distance so far; the
        best is kept by the integer square and the number, so rounding and ties never decide.
        """
        best = np.full(len(rows), np.iinfo(np.int64).max)
        code = np.full(len(rows), len(self.entries), np.int64)
        if self.root is not None:
            self._search(self.root, rows, np.arange(len(rows)), best, code)
        return code, best

    def _search(self, node: Node, rows: np.ndarray, asked: np.ndarray, best: np.ndarray, code: np.ndarray) -> None:
        found = squares(rows[asked], self.entries[node.splits])
        self.compared += found.size
        for split, entry in enumerate(node.splits.tolist()):
            square = found[:, split]
            nearer = (square < best[asked]) | ((square == best[asked]) & (entry < code[asked]))
            best[asked[nearer]] = square[nearer]
            code[asked[nearer]] = entry
        if not node.children:
            return
        distance = np.sqrt(found.astype(np.float64))
        least, most = distance * (1 - SLACK), distance * (1 + SLACK)
        for child, below in enumerate(node.children):
            if below is not None:
                apart = np.maximum(least - node.high[:, child], node.low[:, child] - most).max(1)
                open_ = apart <= np.sqrt(best[asked].astype(np.float64)) * (1 + SLACK)
                if open_.any():
                    self._search(below, rows, asked[open_], best, code)


def whole_numbers(vector: Column, most: int) -> Column:
    """floor(1024 * x) of every component; beyond ``most`` either way it counts as ``most``."""
    floor = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double"), F.lit(-2.0**40)), F.lit(2.0**40)) * SCALE))
    return F.transform(floor, lambda x: F.least(F.greatest(x, F.lit(-most)), F.lit(most)))


def _kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label and components of the vectors that are complete and finite, in PARTS equal parts."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").filter(
        F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    )
    size = -(-(whole.agg(F.max(F.size("embedding"))).first()[0] or 0) // PARTS) * PARTS
    most = 1 << ((62 - max(1, size).bit_length()) // 2 - 1)
    padded = F.concat(whole_numbers(F.col("embedding"), most), F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("embedding")))
    return materialize(whole.select("vec_id", "label", padded.alias("components")), "vectors")


def _first_entries(kept: DataFrame) -> Codebooks:
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "components").select("components").limit(ENTRIES).collect()
    return cut(np.array([r[0] for r in rows], np.int64).reshape(len(rows), -1) if rows else np.zeros((0, 0), np.int64))


def cut(rows: np.ndarray) -> Codebooks:
    """The PARTS equal consecutive parts of each row."""
    size = rows.shape[1] // PARTS
    return [np.ascontiguousarray(rows[:, p * size:(p + 1) * size]) for p in range(PARTS)]


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("components")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), np.int64)


SUMS = "part int, entry int, n long, sums array<long>"
CODED = "vec_id long, label {label}, code string, error long"


def _improved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks with every used entry moved to the mean of its parts, rounded down.

    Each task adds up its own rows, so at most PARTS * ENTRIES sums leave it, whatever the data.
    """
    handle, key = kept.sparkSession.sparkContext.broadcast(books), uuid.uuid4().hex

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = handle.value
        trees = worker_model(("vector codes", key), lambda: [Gnat(b) for b in books])
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for p, rows in enumerate(cut(_rows(batch))):
                code, _ = trees[p].nearest(rows)
                counts[p] += np.bincount(code, minlength=len(books[p]))
                np.add.at(sums[p], code, rows)
        used = [np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(PARTS), [len(u) for u in used]), pa.int32()),
            pa.array(np.concatenate(used), pa.int32()),
            pa.array(np.concatenate([c[u] for c, u in zip(counts, used)]), pa.int64()),
            pa.array([row for s, u in zip(sums, used) for row in s[u].tolist()], pa.list_(pa.int64())),
        ], names=["part", "entry", "n", "sums"])

    parts = kept.select("components").mapInArrow(add, SUMS)
    total = parts.select("part", "entry", "n", F.posexplode("sums").alias("at", "value")).groupBy("part", "entry", "at")
    new = [b.copy() for b in books]
    for part, entry, at, n, value in total.agg(F.sum("n"), F.sum("value")).collect():
        new[part][entry, at] = value // n
    return new


def _coded(kept: DataFrame, books: Codebooks) -> DataFrame:
    handle, key = kept.sparkSession.sparkContext.broadcast(books), uuid.uuid4().hex

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = worker_model(("vector codes", key), lambda: [Gnat(b) for b in handle.value])
        for batch in batches:
            codes, error = np.empty((batch.num_rows, PARTS), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, rows in enumerate(cut(_rows(batch))):
                code, square = trees[p].nearest(rows)
                codes[:, p] = code
                error += square
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error),
            ], names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(assign, CODED.format(label=kept.schema["label"].dataType.simpleString()))


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def fit(kept: DataFrame) -> Codebooks:
    """The codebooks after ROUNDS rounds over all vectors; ENTRIES rows a part, so small enough for the driver."""
    books = _first_entries(kept)
    for _ in range(ROUNDS if len(books[0]) else 0):
        books = _improved(kept, books)
    return books


def reconstructed(coded: DataFrame, books: Codebooks, name: str) -> DataFrame:
    """``coded`` with a new column of the vector each ``code`` stands for, in the vectors' own units."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in b.tolist()]) for b in books])
    picked = [
        F.element_at(F.element_at(entries, p + 1), F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1) for p in range(PARTS)
    ]
    return coded.withColumn(name, F.transform(F.concat(*picked), lambda x: (x + 0.5) / SCALE))


def compressed(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that is complete and finite.

    A vector that is null or holds a null or non-finite component is dropped. Vectors shorter than
    the longest, and lengths that PARTS does not divide, are filled up with zeros. A component so
    large that a sum of squares might not fit a long counts as the largest that does (about 130,000
    for 64 components). Null ids come last among the first entries; of equal ids the smaller vector
    comes first. Repeated rows are coded like others. Fewer vectors than ENTRIES make smaller
    codebooks. An empty table gives an empty result; other columns are not read.
    """
    kept = _kept(vectors)
    books = fit(kept)
    coded = materialize(_coded(kept, books), "codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sized(materialize(totals, "label_errors")), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _round(n: int) -> str:
    """SQL of the assignment to the entries ``c{n}`` and of the entries after it."""
    return f"""
    a{n} AS (
        SELECT v.r, v.part, any_value(v.x) AS x, min_by(c.entry, {{d}} * 256 + c.entry) AS entry, min({{d}}) AS square
        FROM v JOIN c{n} AS c USING (part) GROUP BY v.r, v.part
    ), m{n} AS (
        SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY k) AS x FROM (
            SELECT part, entry, k, CAST(sum(x[k]) AS DOUBLE) AS s, count(*) AS n
            FROM a{n}, unnest(range(1, len(x) + 1)) AS u(k) GROUP BY part, entry, k
        ) GROUP BY part, entry
    ), c{n + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{n} AS c LEFT JOIN m{n} AS m USING (part, entry)),
    """.replace("{d}", "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))")


@query(f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), v AS MATERIALIZED (
        SELECT r, part, x[part * len(x) // {PARTS} + 1:(part + 1) * len(x) // {PARTS}] AS x FROM kept, range({PARTS}) AS p(part)
    ), c0 AS (SELECT part, CAST(r - 1 AS BIGINT) AS entry, x FROM v WHERE r <= {ENTRIES}),
    {"".join(_round(n) for n in range(ROUNDS + 1))}
    coded AS (
        SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(square) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r
    ), books AS (
        SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{ROUNDS}
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), books
""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
