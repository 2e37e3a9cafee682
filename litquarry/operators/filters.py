"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.functions.text import MISSING, is_blank, strip
from litquarry.schemas import NO_SECTION

# Match types, kept columns, excluded disease names, cancer area, species names.
DISEASE_TYPE = "DS"
GENE_TYPE = "GP"
MATCH_COLUMNS = ["pmid", "text", "keywordId", "type", "organisms"]
CANCER_AREA = "MONDO_0045024"
ABSTRACT_CATEGORIES = ["cancer", "neoplasm", "carcinoma", "cirrhosis of liver"]
HUMAN_NAMES = ["human", "humans", "woman", "man"]
DETAIL_COLUMNS = [
    "Abstract_Number", "Genes", "Disease", "Main_Type",
    "Mapped_Indication", "OncoTree_Code", "Top_Level_Group",
]


def literature_filter(
    df: DataFrame,
    section: str = "abstract",
    types: Sequence[str] = (DISEASE_TYPE, GENE_TYPE),
    section_col: str = "section",
    type_col: str = "type",
    columns: Sequence[str] = tuple(MATCH_COLUMNS),
) -> DataFrame:
    """Disease and gene matches from abstracts.

    The section is tested only where the column exists: in the table, and in the file a match comes from.
    """
    if section_col in df.columns:
        df = df.filter(F.col(section_col).isin(section, NO_SECTION))
    return df.filter(F.col(type_col).isin(*types)).select(*columns)


def disease_area_filter(
    df: DataFrame,
    area: str = CANCER_AREA,
    id_contains: str = "EFO",
    exclude_names: Sequence[str] = tuple(ABSTRACT_CATEGORIES),
    id_col: str = "id",
    name_col: str = "name",
    areas_col: str = "therapeuticAreas",
) -> DataFrame:
    """Diseases of one area, one row per mention of the area; a null name is kept."""
    kept = df.filter(
        F.col(id_col).contains(id_contains)
        & (F.col(name_col).isNull() | ~F.col(name_col).isin(*exclude_names))
    )
    return (
        kept.select(id_col, name_col, F.explode(areas_col).alias("_area"))
        .filter(F.col("_area") == area)
        .drop("_area")
    )


def clean_gene_symbols(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Gene identifiers and symbols from tab-separated lines of exactly two fields."""
    fields = F.split(strip(line_col), "\t")
    return (
        lines.select(fields.alias("_fields"))
        .filter(F.size("_fields") == 2)
        .select(F.get("_fields", F.lit(0)).alias("ENSG"), F.get("_fields", F.lit(1)).alias("HUGO"))
        .filter(F.col("HUGO") != "")
    )


def drop_if_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(cols))


def is_valid_gene(col: Column | str) -> Column:
    """Not null, not empty and not the missing-value text."""
    col = F.col(col) if isinstance(col, str) else col
    return col.isNotNull() & ~col.isin("", MISSING)


def valid_gene(df: DataFrame, col: str = "Genes") -> DataFrame:
    return df.filter(is_valid_gene(col))


def is_species(organisms: Column | str, names: Sequence[str] = tuple(HUMAN_NAMES)) -> Column:
    """True where a list of organisms names one of the species."""
    return F.coalesce(F.exists(organisms, lambda o: F.lower(o).isin(*names)), F.lit(False))


def species_filter(
    df: DataFrame, col: str = "organisms", names: Sequence[str] = tuple(HUMAN_NAMES)
) -> DataFrame:
    """Distinct rows, without the list, that name one of the species.

    Testing the list in place gives the rows that exploding it, filtering and
    removing duplicates would give, without multiplying rows first.
    """
    return df.filter(is_species(col, names)).drop(col).distinct()


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Without null and whitespace-only text."""
    return df.filter(~is_blank(col))


def detail_table(df: DataFrame, gene_col: str = "Genes") -> DataFrame:
    """Columns of the detail table for rows with a gene."""
    return valid_gene(df, gene_col).select(*DETAIL_COLUMNS)
