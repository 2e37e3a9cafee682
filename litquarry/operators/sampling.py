"""Seeded order, exact ranks, samples and splits without sorting on one task.

The seeded order of rows is the order of ``md5(seed:key)``, ties by key. The first
hex digits of the digest cut that order into equal buckets, so an exact cut at n
rows needs only the bucket counts: buckets before the cut are taken whole. The bucket
that holds the cut is counted again by its next digits, and rows are ranked only inside
the part that holds it, one in 16 million of all rows.

Every operator here needs a key that is unique per row; ``number_copies`` makes one
for rows that have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from litquarry.functions.hashing import seeded_hash
from litquarry.operators.joins import union_all

# Rows per stratum, sample size, seed, train share, rows per batch.
MAX_PER_LABEL = 2000
SAMPLE_TARGET = 20000
SEED = 123
TRAIN_SHARE = 0.95
BATCH_SIZE = 100

BUCKET_DIGITS = 3  # 4096 buckets
RANK_DIGITS = 4  # 65536 buckets, each ranked by one task
GROUP_DIGITS = 2  # parts of a group that are cut first
COPIES_PER_CHUNK = 1 << 20


def _with_buckets(df: DataFrame, key: str, seed: int | str, digits: int | None = None) -> DataFrame:
    digest = seeded_hash(seed, key)
    return df.withColumn("_hash", digest).withColumn("_bucket", F.substring("_hash", 1, digits or BUCKET_DIGITS))


def _bucket_counts(df: DataFrame, group: Sequence[str], key: str, seed: int | str, digits: int | None = None) -> DataFrame:
    """Rows of each (group, bucket), with the running numbers of ``_running``."""
    hashed = df.select(*group, F.substring(seeded_hash(seed, key), 1, digits or BUCKET_DIGITS).alias("_bucket"))
    return _running(hashed, group, F.count(F.lit(1)))


def _running(rows: DataFrame, group: Sequence[str], total: Column, *more: Column) -> DataFrame:
    """Per (group, bucket): `_rows`, the rows `_before` and `_upto` its end, and the group's `_size`.

    The windows run over buckets, at most 16 to the number of their digits per group.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ordered = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.groupBy(*group, "_bucket")
        .agg(total.alias("_rows"), *more)
        .withColumn("_upto", F.sum("_rows").over(ordered))
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
        .withColumn("_size", F.sum("_rows").over(whole))
    )


def _rank_in_bucket(group: Sequence[str], key: str) -> Column:
    return F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy("_hash", key))


def _shares(counts: DataFrame, quota: Column) -> DataFrame:
    """The rows that each bucket adds to its group's quota; buckets beyond the quota are left out."""
    return counts.withColumn("_take", F.least(quota - F.col("_before"), F.col("_rows"))).filter("_take > 0")


def _with_ranks(hashed: DataFrame, shares: DataFrame, group: str, key: str, how: str) -> DataFrame:
    """Bucketed rows with their `_rank` inside (group, bucket) and the rows to `_take` there.

    Joining and ranking on (group, bucket) spreads a hot group over all its buckets
    and needs one shuffle for both.
    """
    shares = shares.select(F.col(group).alias("_group"), F.col("_bucket").alias("_in"), "_take")
    near = hashed[group].eqNullSafe(shares["_group"]) & (hashed["_bucket"] == shares["_in"])
    return hashed.join(shares, near, how).withColumn("_rank", _rank_in_bucket([group], key))


def cap_per_group(
    df: DataFrame, group: str, n: int = MAX_PER_LABEL, key: str = "pmid", seed: int | str = SEED
) -> DataFrame:
    """The first n rows of each group in seeded order, from one scan.

    Each task cuts the parts of its groups to n rows before any row moves; the parts of a
    group, by the first digits of the order, are then cut one by one, and a group only gets
    what is left of its parts. So a group with a third of all rows is spread over 256 parts.
    """
    hashed = df.withColumn("_hash", seeded_hash(seed, key))
    for within in ([F.col(group), F.substring("_hash", 1, GROUP_DIGITS)], [F.col(group)]):
        place = F.row_number().over(Window.partitionBy(*within).orderBy("_hash", key))
        hashed = hashed.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    return hashed.select(*df.columns)


def take_first(df: DataFrame, n: int | Column, key: str, seed: int | str = SEED) -> DataFrame:
    """The first n rows in seeded order; those before the part that holds row n are taken without a shuffle."""
    hashed = df.withColumn("_hash", seeded_hash(seed, key)).withColumn("_cut", _cut(df, n, key, seed))
    part = F.substring("_hash", 1, 2 * BUCKET_DIGITS)
    clear = hashed.filter(part < F.col("_cut.part"))
    edge = hashed.filter(part == F.col("_cut.part")).withColumn("_rank", _rank_in_part(key))
    return union_all(clear.select(*df.columns), edge.filter(F.col("_rank") <= F.col("_cut.take")).select(*df.columns))


def _rank_in_part(key: str) -> Column:
    return F.row_number().over(Window.partitionBy(F.substring("_hash", 1, 2 * BUCKET_DIGITS)).orderBy("_hash", key))


def _cut(df: DataFrame, n: int | Column, key: str, seed: int | str) -> Column:
    """Scalar subquery: the part in which row n lies and its rows to take; n may use ``_size``.

    The bucket follows from the counts of all buckets, the part from those of the bucket's parts.
    """
    bucket = _cut_of(_bucket_counts(df, [], key, seed), F.lit(n) if isinstance(n, int) else n)
    inside = df.select(seeded_hash(seed, key).alias("_hash")).withColumn("_cut", bucket)
    inside = inside.filter(F.substring("_hash", 1, BUCKET_DIGITS) == F.col("_cut.bucket"))
    parts = inside.groupBy(F.substring("_hash", 1, 2 * BUCKET_DIGITS).alias("_bucket"), F.col("_cut.take").alias("_quota")).count()
    counted = _running(parts.select("_bucket", "_quota", "count"), [], F.sum("count"), F.max("_quota").alias("_quota"))
    part = counted.filter((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_upto")))
    return part.select(F.struct(F.col("_bucket").alias("part"), (F.col("_quota") - F.col("_before")).alias("take"))).scalar()


def _cut_of(counts: DataFrame, n: Column) -> Column:
    quota = F.least(n, F.col("_size"))
    cut = counts.filter((F.col("_before") < quota) & (quota <= F.col("_upto")))
    return cut.select(
        F.struct(F.col("_bucket").alias("bucket"), (quota - F.col("_before")).alias("take"))
    ).scalar()


def stratified_sample(
    df: DataFrame, group: str, target: int = SAMPLE_TARGET, key: str = "pmid", seed: int | str = SEED
) -> DataFrame:
    """A sample of exactly ``target`` rows, or all rows where there are fewer.

    Each stratum gives its first ``floor(size * target / total)`` rows; the first of
    all other rows fill up to the target. Both follow the seeded order.

    The bucket in which the filling ends follows from the counts alone. All rows of
    earlier buckets are in the sample, later buckets give only the strata's shares,
    and just that one bucket needs both.
    """
    counts = _bucket_counts(df, [group], key, seed)
    total = counts.agg(F.sum("_rows")).scalar()
    quota = F.floor(F.col("_size").cast("double") * (F.lit(float(target)) / total.cast("double")))
    shares = _shares(counts, quota)
    taken = shares.agg(F.coalesce(F.sum("_take"), F.lit(0))).scalar()
    left = F.col("_rows") - F.greatest(F.least(quota - F.col("_before"), F.col("_rows")), F.lit(0))
    others = _running(counts.select("_bucket", left.alias("_left")), [], F.sum("_left"))
    end = _cut_of(others, F.lit(target) - taken)

    hashed = _with_buckets(df, key, seed).withColumn("_end", end)
    bucket, last = F.col("_bucket"), F.col("_end.bucket")
    before = hashed.filter(bucket < last)
    after = _with_ranks(hashed.filter(F.coalesce(bucket > last, F.lit(True))), shares, group, key, "inner")
    both = _with_ranks(hashed.filter(bucket == last), shares, group, key, "left").withColumn(
        "_other", F.coalesce(F.col("_rank") > F.col("_take"), F.lit(True))
    )
    place = F.row_number().over(Window.partitionBy("_bucket", "_other").orderBy("_hash", key))
    parts = [
        before,
        after.filter(F.col("_rank") <= F.col("_take")),
        both.withColumn("_place", place).filter(~F.col("_other") | (F.col("_place") <= F.col("_end.take"))),
    ]
    return union_all(*[part.select(*df.columns) for part in parts])


def remaining_rows(df: DataFrame, sampled: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been sampled."""
    return df.join(sampled.select(key), key, "left_anti")


def global_rank(df: DataFrame, key: str, seed: int | str | None = None, alias: str = "rank") -> DataFrame:
    """Exact position, from 1, in seeded order (seed None: the order of ``md5(key)``).

    The offsets are one row per bucket, at most 65536 by construction, hence the broadcast.
    """
    seed = "" if seed is None else seed
    offsets = _bucket_counts(df, [], key, seed, RANK_DIGITS).select("_bucket", "_before")
    return (
        _with_buckets(df, key, seed, RANK_DIGITS)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(alias, F.col("_before") + _rank_in_bucket([], key))
        .select(*df.columns, alias)
    )


def assign_batches(
    df: DataFrame, size: int = BATCH_SIZE, key: str = "pmid", seed: int | str | None = None, alias: str = "batch"
) -> DataFrame:
    """Batch number from 0; every batch but the last has exactly ``size`` rows."""
    ranked = global_rank(df, key, seed, "_position")
    return ranked.withColumn(alias, F.floor((F.col("_position") - 1) / size)).drop("_position")


def seeded_order(df: DataFrame, key: str, seed: int | str = SEED) -> DataFrame:
    """Rows sorted in seeded order: a range-partitioned sort, no single task."""
    return _with_buckets(df, key, seed).orderBy("_hash", key).select(*df.columns)


def number_copies(df: DataFrame, alias: str = "copy") -> DataFrame:
    """Rows with a number, from 1, among their exact copies.

    Copies are counted, not gathered, and handed out in chunks, so no list of numbers is
    longer than a chunk.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    last_chunk = F.floor((F.col("_copies") - 1) / COPIES_PER_CHUNK)
    first = F.col("_chunk") * COPIES_PER_CHUNK + 1
    last = F.least(F.col("_copies"), (F.col("_chunk") + 1) * COPIES_PER_CHUNK)
    chunks = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    return chunks.withColumn(alias, F.explode(F.sequence(first, last))).drop("_copies", "_chunk")


def mix_corpora(
    real: DataFrame, synthetic: DataFrame, n_real: int | None = None, n_synth: int | None = None, key: str = "key",
    seed: int | str = SEED,
) -> DataFrame:
    """Both corpora, or the first rows of each; ``seeded_order`` and the sinks put them in one order."""
    parts = [(real, n_real), (synthetic, n_synth)]
    return union_all(*[part if n is None else take_first(part, n, key, seed) for part, n in parts])


def train_val_split(
    df: DataFrame, key: str = "key", frac: float = TRAIN_SHARE, seed: int | str = SEED, alias: str = "split"
) -> DataFrame:
    """Exactly the first ``int(frac * n)`` rows in seeded order are ``train``, the others ``validation``.

    Only the part that holds the cut is ranked; all other rows get their side without a shuffle.
    """
    cut = _cut(df, F.floor(F.lit(frac) * F.col("_size").cast("double")), key, seed)
    hashed = df.withColumn("_hash", seeded_hash(seed, key)).withColumn("_cut", cut)
    part, last = F.substring("_hash", 1, 2 * BUCKET_DIGITS), F.col("_cut.part")
    side = lambda first: F.when(first, F.lit("train")).otherwise(F.lit("validation"))
    clear = hashed.filter(F.coalesce(part != last, F.lit(True))).withColumn(alias, side(part < last))
    edge = hashed.filter(part == last).withColumn("_rank", _rank_in_part(key))
    edge = edge.withColumn(alias, side(F.col("_rank") <= F.col("_cut.take")))
    return clear.select(*df.columns, alias).unionByName(edge.select(*df.columns, alias))
