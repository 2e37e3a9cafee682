"""Scans, filters, joins and roll-ups of matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from litquarry.catalog import stand_ins as s
from litquarry.catalog.registry import query
from litquarry.operators import filters, joins, rollups
from litquarry.plans import corpus
from litquarry.sources.tables import union_files

PLAIN_COLUMNS = ["pmid", "text", "keywordId", "type"]


def matches(spark, folder):
    """Filtered matches without organism lists."""
    raw = s.raw_matches(spark, folder)
    return filters.literature_filter(raw, s.SECTION, (s.DISEASE, s.GENE), columns=PLAIN_COLUMNS)


def full_matches(spark, folder):
    return filters.literature_filter(s.raw_matches(spark, folder, organisms=True), s.SECTION, (s.DISEASE, s.GENE))


def diseases(spark, folder):
    return filters.disease_area_filter(s.raw_diseases(spark, folder), s.AREA, "EFO", s.EXCLUDED)


def symbols(spark, folder):
    return filters.clean_gene_symbols(s.symbol_lines(spark, folder))


DISEASE_EVIDENCE = f"""{s.MATCHES}, {s.DISEASES}, disease_evidence AS (
  SELECT pmid, string_agg(DISTINCT name, ', ' ORDER BY name) AS disease_name
  FROM matches JOIN diseases ON "keywordId" = id WHERE type = 'A' AND name IS NOT NULL GROUP BY pmid)"""

GENE_EVIDENCE = f"""{DISEASE_EVIDENCE}, {s.SYMBOLS}, gene_evidence AS (
  SELECT pmid, string_agg(DISTINCT "HUGO", ', ' ORDER BY "HUGO") AS gene
  FROM matches JOIN symbols ON "keywordId" = "ENSG"
  WHERE type = 'R' AND pmid IN (SELECT pmid FROM disease_evidence) GROUP BY pmid)"""

COMBINED = f"""{GENE_EVIDENCE}, combined AS (
  SELECT pmid, gene, disease_name, organisms FROM gene_evidence
  LEFT JOIN disease_evidence USING (pmid)
  LEFT JOIN (SELECT DISTINCT pmid, organisms FROM matches) USING (pmid))"""

LABELLED = f"""{COMBINED}, labelled AS (
  SELECT DISTINCT pmid, gene, disease_name
  FROM (SELECT pmid, gene, disease_name, unnest(organisms) AS organism FROM combined)
  WHERE lower(organism) IN ('urgent', 'high'))"""


@query("""SELECT l_orderkey AS pmid, l_returnflag || '-' || l_linestatus AS text,
  (CASE WHEN l_returnflag = 'R' THEN 'ENSG_' ELSE 'EFO_' END) || l_partkey AS "keywordId", l_returnflag AS type
  FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R')""")
def literature_filter(spark, folder):
    return matches(spark, folder)


@query("""SELECT l_orderkey AS pmid, l_partkey AS "keywordId", l_returnflag AS type
  FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def literature_filter_without_section(spark, folder):
    lines = s.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("pmid"), F.col("l_partkey").alias("keywordId"), F.col("l_returnflag").alias("type")
    )
    return filters.literature_filter(lines, s.SECTION, (s.DISEASE, s.GENE), columns=["pmid", "keywordId", "type"])


@query("""SELECT s_suppkey AS id, s_name AS name FROM supplier
  UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_of_files(spark, folder):
    file = f"{folder}/supplier.parquet"
    rows = union_files(spark, [file, f"{folder}/no_such_file.parquet", file])
    return rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


@query(f"WITH {s.DISEASES} SELECT id, name FROM diseases")
def disease_area_filter(spark, folder):
    return diseases(spark, folder)


@query(f'WITH {s.SYMBOLS} SELECT "ENSG", "HUGO" FROM symbols')
def gene_symbols(spark, folder):
    return symbols(spark, folder)


@query(f"""WITH {s.MATCHES}, {s.DISEASES} SELECT pmid, type, name AS disease_name
  FROM matches JOIN diseases ON "keywordId" = id WHERE type = 'A' AND name IS NOT NULL""")
def disease_mentions(spark, folder):
    found = matches(spark, folder).filter(F.col("type") == s.DISEASE).select("pmid", "type", "keywordId")
    return joins.attach_dimension(found, diseases(spark, folder), "keywordId", "id", "name", "disease_name")


@query(f"WITH {DISEASE_EVIDENCE} SELECT pmid, disease_name FROM disease_evidence")
def disease_rollup(spark, folder):
    return corpus.disease_evidence(matches(spark, folder), diseases(spark, folder), s.DISEASE)


@query(f"WITH {DISEASE_EVIDENCE} SELECT pmid FROM disease_evidence")
def distinct_keys(spark, folder):
    return rollups.distinct_keys(disease_rollup(spark, folder), "pmid")


@query(f"""WITH {DISEASE_EVIDENCE} SELECT pmid, "keywordId", type FROM matches
  WHERE pmid IN (SELECT pmid FROM disease_evidence)""")
def restricted_matches(spark, folder):
    keys = disease_rollup(spark, folder).select("pmid")
    return joins.restrict_to(matches(spark, folder).select("pmid", "keywordId", "type"), keys, "pmid")


@query(f"WITH {GENE_EVIDENCE} SELECT pmid, gene FROM gene_evidence")
def gene_rollup(spark, folder):
    keys = disease_rollup(spark, folder).select("pmid")
    return corpus.gene_evidence(matches(spark, folder), symbols(spark, folder), keys, s.GENE)


@query(f"""WITH {DISEASE_EVIDENCE} SELECT DISTINCT pmid, array_to_string(organisms, '|') AS organisms
  FROM matches WHERE pmid IN (SELECT pmid FROM disease_evidence)""")
def distinct_organisms(spark, folder):
    keys = disease_rollup(spark, folder).select("pmid")
    found = corpus.organism_evidence(full_matches(spark, folder), keys)
    return found.withColumn("organisms", F.array_join("organisms", "|"))


def combined(spark, folder):
    return corpus.combined_evidence(
        full_matches(spark, folder), diseases(spark, folder), symbols(spark, folder), s.DISEASE, s.GENE
    )


@query(f"""WITH {COMBINED} SELECT pmid, gene, disease_name, array_to_string(organisms, '|') AS organisms
  FROM combined""")
def combine_evidence(spark, folder):
    return combined(spark, folder).withColumn("organisms", F.array_join("organisms", "|"))


@query(f"WITH {LABELLED} SELECT pmid, gene, disease_name FROM labelled")
def species_filter(spark, folder):
    return filters.species_filter(combined(spark, folder), "organisms", s.SPECIES)


@query(f"WITH {LABELLED} SELECT pmid, gene, disease_name FROM labelled")
def labelled_pmids(spark, folder):
    return corpus.labelled_pmids(
        full_matches(spark, folder), diseases(spark, folder), symbols(spark, folder), s.DISEASE, s.GENE, s.SPECIES
    )


@query("""SELECT count(*) AS rows_in, count(*) FILTER (l_linestatus = 'F') AS in_section,
  count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'A') AS diseases,
  count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'R') AS genes FROM lineitem""")
def funnel_counts(spark, folder):
    in_section = F.col("section") == s.SECTION
    return rollups.funnel(
        s.raw_matches(spark, folder),
        in_section=in_section,
        diseases=in_section & (F.col("type") == s.DISEASE),
        genes=in_section & (F.col("type") == s.GENE),
    )


@query(f"""WITH {COMBINED} SELECT count(*) AS rows_in, count(*) FILTER (gene IS NULL) AS missing_genes,
  count(*) FILTER (lower(organisms[2]) IN ('urgent', 'high')) AS of_species FROM combined""")
def evidence_funnel(spark, folder):
    return rollups.funnel(
        combined(spark, folder),
        missing_genes=F.col("gene").isNull(),
        of_species=filters.is_species("organisms", s.SPECIES),
    )


@query(f"""WITH {LABELLED} SELECT disease_name, count(*) AS count FROM labelled
  GROUP BY disease_name ORDER BY count DESC, disease_name LIMIT 20""")
def top_diseases(spark, folder):
    return rollups.top_values(labelled_pmids(spark, folder), "disease_name", 20)


@query(f"""WITH {LABELLED} SELECT l.pmid, gene, disease_name, source AS title, text AS abstract
  FROM labelled l LEFT JOIN documents d ON l.pmid = d.doc_id""")
def attach_abstracts(spark, folder):
    return joins.attach_abstracts(labelled_pmids(spark, folder), s.pubmed(spark, folder))
