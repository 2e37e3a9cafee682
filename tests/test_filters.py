from conftest import rows
from pyspark.sql import functions as F

from litquarry import schemas
from litquarry.operators import filters, joins, rollups

MATCHES = [
    ("1", "a", "EFO_1", "DS", ["Human"], "abstract"),
    ("1", "b", "ENSG1", "GP", [], "abstract"),
    ("2", "c", "EFO_2", "DS", None, "title"),
    ("3", "d", "CHEM", "CD", ["mice"], "abstract"),
    ("4", "e", "EFO_1", None, ["mice", "humans"], "abstract"),
    ("5", "f", "EFO_1", "DS", ["humans", "mice"], None),
]


def test_literature_filter_with_and_without_section(spark):
    matches = spark.createDataFrame(MATCHES, schemas.MATCHES)
    kept = filters.literature_filter(matches)
    assert kept.columns == ["pmid", "text", "keywordId", "type", "organisms"]
    assert [r[0] for r in rows(kept)] == ["1", "1"]
    kept = filters.literature_filter(matches.drop("section"))
    assert [r[0] for r in rows(kept)] == ["1", "1", "2", "5"]


def test_disease_area_filter_keeps_null_names_and_repeats(spark):
    area = "MONDO_0045024"
    diseases = spark.createDataFrame(
        [
            ("EFO_1", "melanoma", [area, area]),
            ("EFO_2", None, [area]),
            ("EFO_3", "cancer", [area]),
            ("EFO_4", "asthma", ["OTHER"]),
            ("MONDO_5", "sarcoma", [area]),
            ("EFO_6", "glioma", None),
        ],
        schemas.DISEASES,
    )
    assert rows(filters.disease_area_filter(diseases)) == [
        ("EFO_1", "melanoma"), ("EFO_1", "melanoma"), ("EFO_2", None),
    ]


def test_clean_gene_symbols(spark):
    lines = ["ENSG1\tTP53", " ENSG2\tMDM2 ", "", "ENSG3\t", "ENSG4", "ENSG5\tA\tB", "ENSG1\tP53", " ENSG6\tX"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert rows(filters.clean_gene_symbols(df)) == [
        ("ENSG1", "P53"), ("ENSG1", "TP53"), ("ENSG2", "MDM2"), ("ENSG6", "X"),
    ]


def test_species_filter_equals_explode_and_distinct(spark):
    df = spark.createDataFrame(
        [("1", ["Human", "WOMAN"]), ("1", ["mice", "humans"]), ("2", []), ("3", None), ("4", [None, "man"]), ("5", ["mouse"])],
        "pmid string, organisms array<string>",
    )
    exploded = (
        df.withColumn("organisms", F.explode("organisms"))
        .filter(F.lower("organisms").isin(*filters.HUMAN_NAMES)).drop("organisms").distinct()
    )
    assert rows(filters.species_filter(df)) == rows(exploded) == [("1",), ("4",)]


def test_drop_blank_and_null_rows(spark):
    texts = [None, "", " ", "\t\n", "  ", "\x1c", "x", " y "]
    df = spark.createDataFrame([(t, None) for t in texts], "a string, b string")
    assert [r[0] for r in rows(filters.drop_blank(df, "a"))] == [" y ", "x"]
    assert filters.drop_if_all_null(df, ["a", "b"]).count() == 7


def test_valid_gene(spark):
    df = spark.createDataFrame([(g,) for g in ["TP53", "", "n/a", None, " "]], "Genes string")
    assert rows(filters.valid_gene(df)) == [(" ",), ("TP53",)]


def test_dimension_join_drops_unknown_and_null_names_and_fans_out(spark):
    facts = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", None)], "pmid string, k string")
    dim = spark.createDataFrame([("a", "A"), ("a", "AA"), ("b", None)], "id string, name string")
    assert rows(joins.attach_dimension(facts, dim, "k", "id", "name")) == [("1", "A"), ("1", "AA")]


def test_rollup_is_sorted_and_distinct(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "b"), ("2", "c")], "k string, v string")
    assert rows(rollups.rollup_labels(df, "k", "v")) == [("1", "a, b"), ("2", "c")]


def test_organism_lists_compare_in_order(spark):
    df = spark.createDataFrame(
        [("1", ["a", "b"]), ("1", ["b", "a"]), ("1", ["a", "b"])], "pmid string, organisms array<string>"
    )
    assert rollups.distinct_organisms(df).count() == 2


def test_mapping_join_neither_loses_nor_multiplies(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "Disease string")
    mapping = spark.createDataFrame([("a", "A"), (None, None)], "Disease string, m string")
    assert rows(joins.apply_mapping(df, mapping, "Disease")) == [("a", "A"), ("a", "A"), ("z", None), (None, None)]


def test_count_matrix_and_long_form(spark):
    data = [("g", "x"), ("g", "x"), ("g", "y"), ("h", "y"), (None, "x"), ("h", None)]
    df = spark.createDataFrame(data, "Genes string, Main_Type string")
    assert rows(rollups.count_matrix(df)) == [("g", 2, 1), ("h", 0, 1)]
    assert rows(rollups.gene_counts(df)) == [("g", "x", 2), ("g", "y", 1), ("h", "y", 1)]
    assert [tuple(r) for r in rollups.popular_genes(df, ["x", "y"], 2).collect()] == [("g", 3)]
    assert [tuple(r) for r in rollups.top_values(df, "Main_Type", 2).collect()] == [("x", 3), ("y", 2)]


def test_funnel_counts_in_one_row(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(rollups.funnel(df, big=F.col("a") > 1, missing=F.col("a").isNull())) == [(3, 1, 1)]


def test_blocked_matrix_equals_the_pivot_and_has_no_column_limit(spark):
    few = spark.createDataFrame([("g", "a"), ("g", "a"), ("g", "b"), ("h", "c"), (None, "a"), ("h", None)], "Genes string, Main_Type string")
    columns = rollups.matrix_columns(few, width=2)
    names = {(r["block"], r["position"]): r["Main_Type"] for r in columns.collect()}
    assert sorted(names) == [(0, 0), (0, 1), (1, 0)]
    cells = {
        (r["Genes"], names[r["block"], p]): n
        for r in rollups.blocked_matrix(few, columns).collect() for p, n in zip(r["positions"], r["counts"])
    }
    pivot = {(r["Genes"], t): r[t] for r in rollups.count_matrix(few).collect() for t in "abc" if r[t]}
    assert cells == pivot == {("g", "a"): 2, ("g", "b"): 1, ("h", "c"): 1}

    many = spark.range(20_000).selectExpr("concat('g', id % 3) AS Genes", "concat('t', id) AS Main_Type")
    found = rollups.blocked_matrix(many, rollups.matrix_columns(many)).collect()
    assert sum(map(sum, (r["counts"] for r in found))) == 20_000 and len(found) == 60
    assert all(list(r["positions"]) == sorted(set(r["positions"])) and r["positions"][-1] < 1_000 for r in found)
    assert rollups.blocked_matrix(few.limit(0), columns).collect() == []
