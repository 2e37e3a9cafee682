"""The given tables in the domain's shape, as DataFrames and as SQL.

A line item stands for a match in an abstract, its order for the abstract, a part
for the disease or gene that was found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Codes of the given tables in the roles of the domain's values.
SECTION = "F"
DISEASE = "A"
GENE = "R"
AREA = "PROMO"
SPECIES = ["urgent", "high"]
EXCLUDED = ["small ring", "hot gear"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_matches(spark: SparkSession, folder: str, organisms: bool = False) -> DataFrame:
    """Matches of all sections and types; organism lists come from the order and cost a join."""
    lines = table(spark, folder, "lineitem")
    columns = [
        F.col("l_orderkey").alias("pmid"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("text"),
        F.concat(
            F.when(F.col("l_returnflag") == GENE, F.lit("ENSG_")).otherwise(F.lit("EFO_")), F.col("l_partkey")
        ).alias("keywordId"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linestatus").alias("section"),
    ]
    matches = lines.select(*columns)
    if not organisms:
        return matches
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pmid"), F.split("o_orderpriority", "-").alias("organisms")
    )
    return matches.join(orders, "pmid")


RAW_MATCHES = """raw_matches AS (
  SELECT l_orderkey AS pmid, l_returnflag || '-' || l_linestatus AS text,
         (CASE WHEN l_returnflag = 'R' THEN 'ENSG_' ELSE 'EFO_' END) || l_partkey AS "keywordId",
         l_returnflag AS type, l_linestatus AS section, string_split(o_orderpriority, '-') AS organisms
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MATCHES = RAW_MATCHES + """, matches AS (
  SELECT pmid, text, "keywordId", type, organisms FROM raw_matches
  WHERE section = 'F' AND type IN ('A', 'R'))"""


def raw_diseases(spark: SparkSession, folder: str) -> DataFrame:
    """Diseases with ids inside and outside the wanted kind, a repeated area and null names."""
    return table(spark, folder, "part").select(
        F.concat(F.when(F.col("p_size") > 5, F.lit("EFO_")).otherwise(F.lit("MONDO_")), F.col("p_partkey")).alias("id"),
        F.nullif(F.col("p_name"), F.lit("cold rod")).alias("name"),
        F.array("p_type", F.when(F.col("p_size") > 40, F.col("p_type")).otherwise(F.col("p_brand"))).alias(
            "therapeuticAreas"
        ),
    )


DISEASES = """raw_diseases AS (
  SELECT (CASE WHEN p_size > 5 THEN 'EFO_' ELSE 'MONDO_' END) || p_partkey AS id,
         nullif(p_name, 'cold rod') AS name,
         unnest([p_type, CASE WHEN p_size > 40 THEN p_type ELSE p_brand END]) AS area
  FROM part),
diseases AS (
  SELECT id, name FROM raw_diseases
  WHERE area = 'PROMO' AND contains(id, 'EFO')
    AND (name IS NULL OR name NOT IN ('small ring', 'hot gear')))"""


def symbol_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-separated lines: padded, without a symbol, with a third field, and regular ones."""
    return table(spark, folder, "part").select(
        F.concat(
            F.lit("  ENSG_"), F.col("p_partkey"), F.lit("\t"),
            F.when(F.col("p_type") == "LARGE", F.lit("")).otherwise(F.col("p_brand")),
            F.when(F.col("p_type") == "SMALL", F.lit("\textra")).otherwise(F.lit(" ")),
        ).alias("value")
    )


SYMBOLS = """symbols AS (
  SELECT 'ENSG_' || p_partkey AS "ENSG", p_brand AS "HUGO" FROM part WHERE p_type NOT IN ('LARGE', 'SMALL'))"""


def pubmed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("pmid"), F.col("source").alias("title"), F.col("text").alias("abstract")
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a disease for the good ones and a gene for the toxic ones, where labelled."""
    labels = table(spark, folder, "labels")
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("lang") != "es", F.col("text")).otherwise(F.lit(" \t")).alias("abstract"),
        F.when(F.col("quality") == 1, F.col("source")).alias("disease_name"),
        F.when(F.col("toxic") == 1, F.concat_ws(", ", "lang", "source")).alias("gene"),
    )


LABELLED_DOCUMENTS = """labelled AS (
  SELECT d.doc_id, CASE WHEN lang <> 'es' THEN text ELSE chr(32) || chr(9) END AS abstract,
         CASE WHEN quality = 1 THEN source END AS disease_name,
         CASE WHEN toxic = 1 THEN lang || ', ' || source END AS gene
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
