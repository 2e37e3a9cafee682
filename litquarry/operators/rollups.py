"""Aggregations. Each is combined within a task before the shuffle, so a hot key is cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.operators.filters import valid_gene
from litquarry.operators.sampling import global_rank

BLOCK_COLUMNS = 1_000
"""Columns of a block of the blocked matrix."""


def joined_labels(value: Column | str, sep: str = ", ") -> Column:
    """Aggregate: distinct values in order, joined to one text.

    The text is bounded by the number of distinct labels, not by the rows of the key.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.array_join(F.array_sort(F.collect_set(value)), sep)


def rollup_labels(df: DataFrame, key: str, value: str, sep: str = ", ", alias: str | None = None) -> DataFrame:
    """One row per key with its distinct labels."""
    return df.groupBy(key).agg(joined_labels(F.col(value).cast("string"), sep).alias(alias or value))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def distinct_organisms(df: DataFrame, key: str = "pmid", organisms: str = "organisms") -> DataFrame:
    """Distinct (key, list) pairs; the order inside a list counts."""
    return df.select(key, organisms).distinct()


def funnel(df: DataFrame, **stages: Column) -> DataFrame:
    """One row of counts from one pass: all rows, and the rows meeting each named condition."""
    counts = [F.count_if(condition).alias(name) for name, condition in stages.items()]
    return df.agg(F.count(F.lit(1)).alias("rows_in"), *counts)


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The n most frequent values."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col).limit(n)


def gene_counts(df: DataFrame, row: str = "Genes", col: str = "Main_Type") -> DataFrame:
    """Rows per (gene, main type), without null keys: the long form of the count matrix."""
    return (
        df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(row, col)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def count_matrix(
    df: DataFrame, row: str = "Genes", col: str = "Main_Type", values: Sequence[str] | None = None
) -> DataFrame:
    """Gene by main type counts, zero where there is none.

    Pass the column values to spare the job that finds them.
    """
    filled = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    pivoted = filled.groupBy(row).pivot(col, list(values) if values is not None else None)
    return pivoted.agg(F.count(F.lit(1))).na.fill(0)


def matrix_columns(df: DataFrame, col: str = "Main_Type", width: int = BLOCK_COLUMNS) -> DataFrame:
    """Each column of the blocked matrix: value, block and position in it, both from 0, in the order of the value's digest."""
    values = df.filter(F.col(col).isNotNull()).select(col).distinct()
    place = F.col("_number") - 1
    numbered = global_rank(values, col, None, "_number")
    return numbered.select(col, F.floor(place / width).alias("block"), (place % width).cast("int").alias("position"))


def blocked_matrix(
    df: DataFrame, columns: DataFrame, row: str = "Genes", col: str = "Main_Type"
) -> DataFrame:
    """The count matrix for any number of columns: row, block, positions and counts of the cells that are not zero.

    ``columns`` are those of ``matrix_columns``. A pivot makes one column of each value and stops at
    Spark's limit of them; here a row of the result holds the cells of one block of columns,
    sorted by position, so none is longer than a block is wide. Rows with a null in ``row`` or ``col``
    are left out, as from the pivot.
    """
    cells = gene_counts(df, row, col).join(columns, col)
    sparse = cells.groupBy(row, "block").agg(F.array_sort(F.collect_list(F.struct("position", "count"))).alias("_cells"))
    return sparse.select(row, "block", F.col("_cells.position").alias("positions"), F.col("_cells.count").alias("counts"))


def type_totals(counts: DataFrame, col: str = "Main_Type", distinct_on: str | None = None) -> DataFrame:
    """Gene rows per main type; with ``distinct_on``, distinct values of that column instead."""
    kept = counts.filter(F.col(col).isNotNull())
    total = F.count(F.lit(1)) if distinct_on is None else F.count_distinct(distinct_on)
    return kept.groupBy(col).agg(total.alias("total"))


def most_common_type(totals: DataFrame, col: str = "Main_Type") -> DataFrame:
    return totals.orderBy(F.desc("total"), col).limit(1)


def gene_cube(df: DataFrame, row: str = "Genes", col: str = "Main_Type") -> DataFrame:
    """Counts per gene and type, per gene and per type in one table: row, col, level, rows and typed rows.

    ``level`` is the grouping id: CELLS, BY_ROW or BY_COLUMN; ``typed`` leaves out rows whose type is null, and a
    null type is a group of its own. The gene rows are shuffled once, by gene and type; the grouping sets
    go over those counts. Rows without a valid gene are left out.
    """
    cells = valid_gene(df, row).groupBy(row, col).agg(F.count(F.lit(1)).alias("rows"))
    cells = cells.withColumn("typed", F.when(F.col(col).isNotNull(), F.col("rows")).otherwise(0))
    return cells.groupingSets([[row, col], [row], [col]], row, col).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("rows").alias("rows"), F.sum("typed").alias("typed")
    )


CELLS, BY_ROW, BY_COLUMN = 0, 1, 2
"""Levels of a cube: grouping ids of (row, col), of the row alone and of the column alone."""


def cube_cells(cube: DataFrame, row: str = "Genes", col: str = "Main_Type") -> DataFrame:
    """What ``gene_counts`` gives of the cube's rows."""
    return cube.filter((F.col("level") == CELLS) & F.col(col).isNotNull()).select(row, col, F.col("rows").alias("count"))


def cube_matrix(cube: DataFrame, values: Sequence[str], row: str = "Genes", col: str = "Main_Type") -> DataFrame:
    """What ``count_matrix`` gives of the cube's rows."""
    return cube_cells(cube, row, col).groupBy(row).pivot(col, list(values)).agg(F.sum("count")).na.fill(0)


def cube_totals(cube: DataFrame, col: str = "Main_Type") -> DataFrame:
    """What ``type_totals`` gives of the cube's rows."""
    return cube.filter((F.col("level") == BY_COLUMN) & F.col(col).isNotNull()).select(col, F.col("rows").alias("total"))


def cube_types(cube: DataFrame, col: str = "Main_Type") -> DataFrame:
    """The distinct types of the cube's rows in order, null too where a row has none."""
    return cube.filter(F.col("level") == BY_COLUMN).select(col).orderBy(col)


def cube_popular(
    cube: DataFrame, types: Sequence[str] | None = None, min_count: int = 5, row: str = "Genes", col: str = "Main_Type"
) -> DataFrame:
    """What ``popular_genes`` gives of the cube's rows."""
    if types is None:
        totals = cube.filter((F.col("level") == BY_ROW) & (F.col("typed") > 0)).select(row, F.col("typed").alias("total"))
    else:
        totals = cube_cells(cube, row, col).filter(F.col(col).isin(*types)).groupBy(row).agg(F.sum("count").alias("total"))
    return totals.filter(F.col("total") >= min_count).orderBy(F.desc("total"), row)


def popular_genes(
    df: DataFrame,
    types: Sequence[str] | None = None,
    min_count: int = 5,
    row: str = "Genes",
    col: str = "Main_Type",
) -> DataFrame:
    """Genes by their rows over the selected main types, most frequent first."""
    chosen = F.col(col).isNotNull() if types is None else F.col(col).isin(*types)
    return (
        valid_gene(df, row)
        .filter(chosen)
        .groupBy(row)
        .agg(F.count(F.lit(1)).alias("total"))
        .filter(F.col("total") >= min_count)
        .orderBy(F.desc("total"), row)
    )


def group_indications(
    mapping: DataFrame, indication: str = "Disease", main_type: str = "mainType", matched: str = "matched_name"
) -> DataFrame:
    """Indications under their main type, one row each; unmapped indications are left out.

    Rows rather than one list per type: a frequent type may have more indications
    than one task should hold.
    """
    return mapping.filter(F.col(matched).isNotNull()).select(main_type, indication).distinct()


def distinct_values(df: DataFrame, col: str, ordered: bool = False) -> DataFrame:
    values = df.select(col).distinct()
    return values.orderBy(col) if ordered else values
