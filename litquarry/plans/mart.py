"""From parsed extractions to gene tables per tumour type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from litquarry.operators import rollups
from litquarry.operators.extraction import explode_genes
from litquarry.operators.filters import detail_table, drop_if_all_null
from litquarry.operators.ontology import THRESHOLD, map_back, map_indications
from litquarry.session import materialize


def gene_rows(
    extractions: DataFrame,
    ontology: DataFrame,
    groups: DataFrame,
    threshold: int = THRESHOLD,
    method: str = "levenshtein",
) -> tuple[DataFrame, DataFrame]:
    """One row per gene with its mapped indication, and the mapping itself; both are written tables.

    The genes are written before they are mapped, since the mapping reads them too and the
    extractions may come from answers that must not be asked for again.
    """
    rows = materialize(drop_if_all_null(explode_genes(extractions), ["Disease", "Genes"]), "genes")
    mapping = materialize(map_indications(rows, ontology, "Disease", threshold, method), "mapping")
    return materialize(map_back(rows, mapping, groups), "gene_rows"), mapping


def gene_mart(
    extractions: DataFrame,
    ontology: DataFrame,
    groups: DataFrame,
    types: Sequence[str] | None = None,
    min_count: int = 5,
    threshold: int = THRESHOLD,
    method: str = "levenshtein",
) -> dict[str, DataFrame]:
    """The tables of the dashboard, by name, from the written gene rows and mapping.

    All counts are slices of one written cube of them, so the gene rows are shuffled once.
    """
    rows, mapping = gene_rows(extractions, ontology, groups, threshold, method)
    cube = materialize(rollups.gene_cube(rows), "gene_cube")
    totals = rollups.cube_totals(cube)
    return {
        "rows": rows,
        "mapping": mapping,
        "indications": rollups.group_indications(mapping, "Disease", "mainType"),
        "main_types": rollups.cube_types(cube),
        "gene_counts": rollups.cube_cells(cube),
        "totals": totals,
        "most_common": rollups.most_common_type(totals),
        "popular": rollups.cube_popular(cube, types, min_count),
        "detail": detail_table(rows),
    }
