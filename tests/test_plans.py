"""Physical plans: what must and must not be in them."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from litquarry.catalog import ontologies, queries
from litquarry.operators import joins

FOLDER = "/root/testdata/sf0.001"
WRITES = {name for name in queries if name.endswith("_files")} | {
    "incremental_ingest", "ingest_totals", "saved_answers", "corpus_build", "corpus_funnel", "training_set", "stratified_sample", "exported_order",
    "section_per_file", "page_extraction", "generated_negatives", "ontology_fuzzy_weighted",
}
PYTHON = {"extract_batch"}


@pytest.mark.parametrize("name", sorted(set(queries) - WRITES))
def test_no_cross_joins_and_python_only_where_planned(spark, name):
    plan = plan_of(queries[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "InPandas" in plan) == (name in PYTHON)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(queries["literature_filter"](spark, FOLDER))
    assert "In(l_linestatus, [(no section column),F])" in plan.replace("[F,(no section column)]", "[(no section column),F]")
    assert "In(l_returnflag, [A,R])" in plan
    assert "l_quantity" not in plan and "l_shipdate" not in plan
    plan = plan_of(queries["disease_rollup"](spark, FOLDER))
    assert "EqualTo(l_returnflag,A)" in plan and "In(l_linestatus, [" in plan


def test_membership_is_a_semi_join(spark):
    assert "LeftSemi" in plan_of(queries["gene_rollup"](spark, FOLDER))
    assert "LeftAnti" in plan_of(queries["remaining_rows"](spark, FOLDER))


def test_split_shuffles_only_the_bucket_of_the_cut(spark):
    plan = plan_of(queries["train_val_split"](spark, FOLDER))
    main = plan.split("===== Subqueries =====")[0]
    assert main.count("Exchange") - main.count("ENSURE_REQUIREMENTS") <= 2  # tree and detail of one exchange


def test_broadcast_depends_on_size(spark):
    """Small dimensions are broadcast, larger ones merged: no hint fixes the choice."""
    facts = spark.range(100).selectExpr("id AS pmid", "id % 5 AS k")
    dim = spark.range(1000).selectExpr("id", "concat('n', id) AS name")
    joined = joins.attach_dimension(facts, dim, "k", "id", "name")
    assert "BroadcastHashJoin" in plan_of(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(joins.attach_dimension(facts, dim, "k", "id", "name"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["labelled_pmids", "map_indications", "cap_per_group", "mapped_gene_rows"])
def test_same_rows_without_any_broadcast(spark, name):
    """The way beyond the broadcast threshold gives the same rows."""
    first = sorted(map(tuple, queries[name](spark, FOLDER).collect()), key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, queries[name](spark, FOLDER).collect()), key=repr) == first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_evidence_is_one_scan_and_one_shuffle_on_pmid(spark):
    matches = spark.createDataFrame([], "pmid string, type string, keywordId string, organisms array<string>")
    from litquarry.plans.corpus import labelled_pmids

    diseases = spark.createDataFrame([], "id string, name string")
    symbols = spark.createDataFrame([], "ENSG string, HUGO string")
    plan = plan_of(labelled_pmids(matches, diseases, symbols).select(F.col("pmid")))
    assert plan.count("hashpartitioning(pmid") == 1


def test_counts_of_the_mart_shuffle_the_gene_rows_once(spark):
    from litquarry.plans.mart import gene_mart

    tables = gene_mart(*(part(spark, FOLDER) for part in (ontologies.extractions, ontologies.tumor_types, ontologies.groups)))
    for name in ("main_types", "gene_counts", "totals", "most_common", "popular"):
        assert "gene_cube-" in plan_of(tables[name]) and "gene_rows-" not in plan_of(tables[name])
    assert "Exchange" not in plan_of(tables["gene_counts"]) and "Exchange" not in plan_of(tables["totals"])
