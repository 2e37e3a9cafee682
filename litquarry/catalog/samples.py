"""Seeded orders, samples, batches and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from litquarry.catalog import evidence, stand_ins as s
from litquarry.catalog.registry import query
from litquarry.operators import sampling
from litquarry.plans import corpus
from litquarry.session import materialize


def orders(spark, folder):
    return s.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")


CAPPED = """capped AS (SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('123:' || o_orderkey), o_orderkey) <= 2000)"""


def sample_sql(source: str, key: str, group: str, target: int | str) -> str:
    """SQL of a proportional sample with top-up, as table ``sample`` over ``source``."""
    return f"""ranked AS (SELECT *, md5('123:' || {key}) AS h,
  row_number() OVER (PARTITION BY {group} ORDER BY md5('123:' || {key}), {key}) AS rn,
  count(*) OVER (PARTITION BY {group}) AS size, count(*) OVER () AS total FROM {source}),
flagged AS (SELECT *, rn <= floor(size::DOUBLE * ({target}::DOUBLE / total::DOUBLE)) AS first_pick FROM ranked),
rest AS (SELECT *, row_number() OVER (ORDER BY h, {key}) AS rest_rank FROM flagged WHERE NOT first_pick),
sample AS (SELECT * EXCLUDE (rest_rank) FROM rest
  WHERE rest_rank <= {target} - (SELECT count(*) FROM flagged WHERE first_pick)
  UNION ALL SELECT * FROM flagged WHERE first_pick)"""


@query(f"WITH {CAPPED} SELECT * FROM capped")
def cap_per_group(spark, folder):
    return sampling.cap_per_group(orders(spark, folder), "o_orderpriority", 2000, "o_orderkey")


@query(f"WITH {CAPPED}, {sample_sql('capped', 'o_orderkey', 'o_orderpriority', 1003)} "
       "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM sample")
def stratified_sample(spark, folder):
    capped = materialize(cap_per_group(spark, folder), "capped")
    return sampling.stratified_sample(capped, "o_orderpriority", 1003, "o_orderkey")


@query(f"WITH {CAPPED} SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM capped)")
def remaining_rows(spark, folder):
    capped = cap_per_group(spark, folder)
    return sampling.remaining_rows(orders(spark, folder), capped, "o_orderkey").select("o_orderkey")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY md5('123:' || o_orderkey), o_orderkey) AS rank FROM orders")
def global_rank(spark, folder):
    return sampling.global_rank(orders(spark, folder).select("o_orderkey"), "o_orderkey", sampling.SEED)


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5('123:' || o_orderkey), o_orderkey")
def seeded_order(spark, folder):
    return sampling.seeded_order(orders(spark, folder).select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY md5('123:' || o_orderkey), o_orderkey LIMIT 8000")
def take_first(spark, folder):
    return sampling.take_first(orders(spark, folder).select("o_orderkey"), 8000, "o_orderkey")


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY md5(':' || o_orderkey), o_orderkey) - 1) // 100 AS batch
  FROM orders""")
def batches(spark, folder):
    return sampling.assign_batches(orders(spark, folder).select("o_orderkey"), 100, "o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey)
  <= floor(0.95::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split FROM orders""")
def train_val_split(spark, folder):
    return sampling.train_val_split(orders(spark, folder).select("o_orderkey"), "o_orderkey", 0.95, 7)


@query("""SELECT md5(text) AS digest, row_number() OVER (PARTITION BY text) AS copy FROM documents""")
def number_copies(spark, folder):
    texts = s.table(spark, folder, "documents").select("text")
    return sampling.number_copies(texts).select(F.md5("text").alias("digest"), "copy")


def corpora(spark, folder):
    real = s.table(spark, folder, "documents").select(
        F.concat(F.lit("real:"), F.col("doc_id")).alias("key"), F.lit("real").alias("origin"), "text"
    )
    synthetic = s.table(spark, folder, "benchmark").select(
        F.concat(F.lit("synthetic:"), F.col("item_id")).alias("key"), F.lit("synthetic").alias("origin"), "text"
    )
    return real, synthetic


MIXED = """mixed AS (SELECT 'real:' || doc_id AS key, 'real' AS origin, text FROM documents
  UNION ALL SELECT 'synthetic:' || item_id, 'synthetic', text FROM benchmark)"""


@query(f"""WITH {MIXED} SELECT key, origin, text, row_number() OVER (ORDER BY md5('9:' || key), key) AS position
  FROM mixed""")
def mix_corpora(spark, folder):
    mixed = sampling.mix_corpora(*corpora(spark, folder))
    return sampling.global_rank(mixed, "key", 9, "position")


LABELLED_SAMPLE = f"""{evidence.LABELLED}, capped AS (SELECT * FROM labelled
  QUALIFY row_number() OVER (PARTITION BY disease_name ORDER BY md5('123:' || pmid), pmid) <= 3),
  aim AS (SELECT count(*) // 2 + 1 AS aim FROM labelled),
  {sample_sql('capped', 'pmid', 'disease_name', '(SELECT aim FROM aim)')}"""


def corpus_of(spark, folder, **options):
    """The corpus of the given tables, half of all labelled rows."""
    labelled = corpus.labelled_pmids(
        evidence.full_matches(spark, folder), evidence.diseases(spark, folder), evidence.symbols(spark, folder), s.DISEASE, s.GENE, s.SPECIES
    )
    return corpus.build_corpus(
        s.raw_matches(spark, folder, organisms=True),
        s.raw_diseases(spark, folder),
        evidence.symbols(spark, folder),
        s.pubmed(spark, folder),
        target=labelled.count() // 2 + 1,
        cap=3,
        section=s.SECTION,
        disease_type=s.DISEASE,
        gene_type=s.GENE,
        area=s.AREA,
        exclude_names=s.EXCLUDED,
        species=s.SPECIES,
        **options,
    )


@query(f"""WITH {LABELLED_SAMPLE} SELECT s.pmid, gene, disease_name, source AS title, text AS abstract
  FROM sample s LEFT JOIN documents d ON s.pmid = d.doc_id""")
def corpus_build(spark, folder):
    """Raw tables to labelled, sampled abstracts."""
    return corpus_of(spark, folder)


@query(f"""WITH {LABELLED_SAMPLE} SELECT 'matches' AS stage, count(*) AS rows FROM raw_matches
  UNION ALL SELECT 'filtered', count(*) FROM matches UNION ALL SELECT 'labelled', count(*) FROM labelled
  UNION ALL SELECT 'sampled', count(*) FROM sample""")
def corpus_funnel(spark, folder):
    """Rows of each stage of a corpus build, counted as they pass."""
    funnel = {}
    corpus_of(spark, folder, funnel=funnel)
    return corpus.funnel_table(spark, funnel)
