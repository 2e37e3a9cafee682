"""Indications mapped to an ontology, and gene tables per main type."""

from __future__ import annotations

from pyspark.sql import functions as F

from litquarry.catalog import stand_ins as s
from litquarry.catalog.registry import query
from litquarry.catalog.texts import clean_sql
from litquarry.operators import extraction, filters, joins, ontology, rollups
from litquarry.plans import mart
from litquarry.session import materialize


def tumor_types(spark, folder):
    """Part names as tumour names, their types as main types; the first part gives the position."""
    return (
        s.table(spark, folder, "part")
        .groupBy(F.col("p_name").alias("name"), F.lower("p_type").alias("mainType"))
        .agg(F.min("p_partkey").alias("ordinal"))
        .select("ordinal", "name", F.concat(F.lit("C"), "ordinal").alias("code"), "mainType")
    )


TUMORS = """tumors AS (SELECT p_name AS name, lower(p_type) AS "mainType", min(p_partkey) AS ordinal,
  'C' || min(p_partkey) AS code FROM part GROUP BY p_name, lower(p_type)),
forms AS (SELECT ordinal, 0 AS kind, name AS text, name AS matched_name, code, "mainType" FROM tumors
  UNION ALL SELECT ordinal, 1, "mainType", 'NA', 'NA', "mainType" FROM tumors),
candidates AS (SELECT * FROM forms QUALIFY row_number() OVER (PARTITION BY text ORDER BY ordinal, kind) = 1)"""


def extractions(spark, folder):
    """One extraction per part: exact, near, missing and foreign indications with every shape of genes."""
    size, kind, brand = F.col("p_size"), F.col("p_type"), F.col("p_brand")
    disease = (
        F.when(size <= 10, F.col("p_name"))
        .when(size <= 20, F.concat("p_name", F.lit(" (stage "), size, F.lit("), metastatic")))
        .when(size <= 30, F.concat("p_name", F.lit("s")))
        .when(size <= 35, F.initcap(kind))
        .when(size <= 40, F.lit("n/a"))
        .when(size <= 45, F.lit(None))
        .otherwise(F.concat(F.lit("-- "), brand))
    )
    genes = (
        F.when(kind == "ECONOMY", F.concat(F.lit('"'), brand, F.lit(', GENE1"')))
        .when(kind == "SMALL", F.concat(F.lit('["'), brand, F.lit('", "GENE2 "]')))
        .when(kind == "MEDIUM", F.lit('"n/a"'))
        .when(kind == "LARGE", F.when(size > 25, F.lit("[]")).otherwise(F.lit('["n/a"]')))
        .when(kind == "PROMO", F.concat(F.lit('"'), brand, F.lit(',,GENE3"')))
        .otherwise(F.lit("17"))
    )
    return s.table(spark, folder, "part").select(
        F.concat("p_partkey", F.lit(" Poster Session")).alias("abstract"),
        disease.alias("Disease"),
        F.parse_json(genes).alias("Genes"),
        F.lit(None).cast("string").alias("comment"),
    )


ROWS = f"""raw AS (SELECT p_partkey::VARCHAR AS "Abstract_Number", p_partkey || ' Poster Session' AS "Abstract",
  CASE WHEN p_size <= 10 THEN p_name WHEN p_size <= 20 THEN p_name || ' (stage ' || p_size || '), metastatic'
    WHEN p_size <= 30 THEN p_name || 's'
    WHEN p_size <= 35 THEN substr(p_type, 1, 1) || lower(substr(p_type, 2))
    WHEN p_size <= 45 THEN NULL ELSE '-- ' || p_brand END AS "Disease",
  CASE p_type WHEN 'ECONOMY' THEN [p_brand, 'GENE1'] WHEN 'SMALL' THEN [p_brand, 'GENE2']
    WHEN 'PROMO' THEN [p_brand, NULL, 'GENE3'] WHEN 'LARGE' THEN CASE WHEN p_size > 25 THEN [] ELSE ['n/a'] END
    ELSE [NULL] END AS genes FROM part),
gene_rows AS (SELECT * FROM (SELECT "Abstract_Number", "Abstract", "Disease", unnest(genes)::VARCHAR AS "Genes" FROM raw)
  WHERE "Disease" IS NOT NULL OR "Genes" IS NOT NULL)"""

INDICATIONS = f"""{TUMORS}, {ROWS},
indications AS (SELECT DISTINCT "Disease", {clean_sql('"Disease"')} AS cleaned FROM gene_rows),
exact AS (SELECT i.*, c.matched_name, c.code, c."mainType" FROM indications i
  LEFT JOIN candidates c ON cleaned = text AND cleaned <> '')"""

NEAR = f"""{INDICATIONS},
scored AS (SELECT DISTINCT e.cleaned, c.*,
    100.0::DOUBLE * (1.0::DOUBLE - levenshtein(e.cleaned, text)::DOUBLE / greatest(length(e.cleaned), length(text))) AS score
  FROM exact e, candidates c WHERE e.matched_name IS NULL AND e.cleaned <> ''),
near AS (SELECT * FROM scored WHERE score > 80
  QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY score DESC, ordinal, kind) = 1),
mapping AS (SELECT e."Disease", coalesce(e.matched_name, n.matched_name) AS matched_name,
    coalesce(e.code, n.code) AS code, coalesce(e."mainType", n."mainType") AS "mainType"
  FROM exact e LEFT JOIN near n ON e.cleaned = n.cleaned)"""

MART = f"""{NEAR},
groups AS (SELECT DISTINCT lower(p_type) AS "mainType", 'Group ' || p_type AS top_group FROM part WHERE p_type < 'P'),
mart AS (SELECT r.*, CASE WHEN matched_name <> 'NA' THEN matched_name WHEN matched_name = 'NA' THEN m."mainType" END
    AS "Mapped_Indication", code AS "OncoTree_Code", m."mainType" AS "Main_Type",
    coalesce(top_group, 'Other Cancer') AS "Top_Level_Group"
  FROM gene_rows r LEFT JOIN mapping m ON r."Disease" = m."Disease" LEFT JOIN groups g ON m."mainType" = g."mainType"),
with_gene AS (SELECT * FROM mart WHERE "Genes" IS NOT NULL AND "Genes" NOT IN ('', 'n/a'))"""


def groups(spark, folder):
    types = s.table(spark, folder, "part").select("p_type").distinct().filter(F.col("p_type") < "P")
    return types.select(F.lower("p_type").alias("mainType"), F.concat(F.lit("Group "), "p_type").alias("top_group"))


def rows(spark, folder):
    exploded = extraction.explode_genes(extractions(spark, folder))
    return filters.drop_if_all_null(exploded, ["Disease", "Genes"])


def mapping(spark, folder, method="levenshtein"):
    return ontology.map_indications(rows(spark, folder), tumor_types(spark, folder), method=method)


def gene_table(spark, folder):
    return ontology.map_back(rows(spark, folder), mapping(spark, folder), groups(spark, folder))


@query(f"WITH {ROWS} SELECT * FROM gene_rows")
def explode_genes(spark, folder):
    return rows(spark, folder)


@query(f'WITH {TUMORS} SELECT text, ordinal, kind, matched_name, code, "mainType" FROM candidates')
def match_candidates(spark, folder):
    found = ontology.match_candidates(tumor_types(spark, folder))
    return found.select("text", "ordinal", "kind", "match.*")


@query(f'WITH {INDICATIONS} SELECT "Disease", cleaned, matched_name, code, "mainType" FROM exact')
def ontology_exact(spark, folder):
    indications = rows(spark, folder).select("Disease").distinct().withColumn(
        "cleaned", ontology.clean_indication("Disease")
    )
    return ontology.match_exact(indications, tumor_types(spark, folder)).select("Disease", "cleaned", "match.*")


ALL_NEAR = f"""{TUMORS},
texts AS (SELECT DISTINCT lower(p_name) || 's' AS cleaned FROM part UNION
  SELECT DISTINCT lower(p_brand) || ' ' || lower(p_type) FROM part UNION
  SELECT DISTINCT substr(p_name, 1, length(p_name) - 1) FROM part),
scored AS (SELECT cleaned, c.*,
    100.0::DOUBLE * (1.0::DOUBLE - levenshtein(cleaned, text)::DOUBLE / greatest(length(cleaned), length(text))) AS score
  FROM texts, candidates c),
near AS (SELECT * FROM scored WHERE score > 80
  QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY score DESC, ordinal, kind) = 1)"""


def altered_names(spark, folder):
    part = s.table(spark, folder, "part")
    name = F.col("p_name")
    forms = [
        F.concat(F.lower(name), F.lit("s")),
        F.concat_ws(" ", F.lower("p_brand"), F.lower("p_type")),
        F.substring(name, F.lit(1), F.length(name) - 1),
    ]
    return part.select(F.explode(F.array(*forms)).alias("cleaned"))


@query(f'WITH {ALL_NEAR} SELECT cleaned, score, matched_name, code, "mainType" FROM near')
def ontology_fuzzy_levenshtein(spark, folder):
    found = ontology.match_fuzzy(
        altered_names(spark, folder), tumor_types(spark, folder), method="levenshtein"
    )
    return found.select("cleaned", "score", "match.*")


@query("""WITH names AS (SELECT p_name, min(p_partkey) AS ordinal FROM part GROUP BY p_name),
  words AS (SELECT *, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second FROM names)
  SELECT second || ' ' || first AS cleaned, 95.0::DOUBLE AS score, p_name AS matched_name, 'C' || ordinal AS code FROM words
  UNION ALL SELECT upper(first) || '-' || second || ' !', 100.0::DOUBLE, p_name, 'C' || ordinal FROM words""")
def ontology_fuzzy_weighted(spark, folder):
    """Scores with a closed form: tokens in another order, punctuation and case only, and names far from all others."""
    names = s.table(spark, folder, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ordinal"))
    tumors = names.select("ordinal", "name", F.concat(F.lit("C"), "ordinal").alias("code"), F.lit(None).cast("string").alias("mainType"))
    words = F.split("name", " ")
    texts = names.select(F.explode(F.array(
        F.concat_ws(" ", words[1], words[0]),
        F.concat(F.upper(words[0]), F.lit("-"), words[1], F.lit(" !")),
        F.concat(F.lit("qqxx"), F.reverse("name"), F.lit("zz")),
    )).alias("cleaned"))
    found = ontology.match_fuzzy(texts, tumors, method="wratio")
    return found.select("cleaned", "score", "match.matched_name", "match.code")


TOKEN_SCORES = """names AS (SELECT p_name, min(p_partkey) AS ordinal FROM part GROUP BY p_name),
  words AS (SELECT *, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second FROM names),
  texts AS (SELECT DISTINCT unnest([second || ' ' || first || 's', first || ' ' || second || ' tumour', second || ' none']) AS cleaned FROM words),
  tokens AS (SELECT t, list_sort(list_distinct(string_split(t, ' '))) AS words, array_to_string(list_sort(string_split(t, ' ')), ' ') AS sorted
    FROM (SELECT cleaned AS t FROM texts UNION SELECT p_name FROM names)),
  pairs AS (SELECT cleaned, p_name, ordinal, a.words AS a, b.words AS b, a.sorted AS x, b.sorted AS y
    FROM texts, names, tokens AS a, tokens AS b WHERE a.t = cleaned AND b.t = p_name),
  scored AS (SELECT cleaned, p_name, ordinal, greatest(
      200.0::DOUBLE * length(array_to_string(list_intersect(a, b), '')) / (length(array_to_string(a, '')) + length(array_to_string(b, ''))),
      100.0::DOUBLE * (1.0::DOUBLE - levenshtein(x, y)::DOUBLE / greatest(length(x), length(y)))) AS score FROM pairs)"""


def token_texts(spark, folder):
    """Names with their words in another order and misspelt, with another word, and with one word only; and all names."""
    names = s.table(spark, folder, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ordinal"))
    tumors = names.select("ordinal", "name", F.concat(F.lit("C"), "ordinal").alias("code"), F.lit(None).cast("string").alias("mainType"))
    words = F.split("name", " ")
    texts = F.array(
        F.concat(words[1], F.lit(" "), words[0], F.lit("s")), F.concat("name", F.lit(" tumour")), F.concat(words[1], F.lit(" none"))
    )
    return names.select(F.explode(texts).alias("cleaned")), tumors


@query(f"""WITH {TOKEN_SCORES} SELECT cleaned, score, p_name AS matched_name, 'C' || ordinal AS code FROM scored WHERE score > 70
  QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY score DESC, ordinal) = 1""")
def ontology_fuzzy_tokens(spark, folder):
    """Matches by words in any order, in columns only."""
    found = ontology.match_fuzzy(*token_texts(spark, folder), threshold=70, method="tokens")
    return found.select("cleaned", "score", "match.matched_name", "match.code")


@query(f"""WITH {TOKEN_SCORES} SELECT cleaned, CAST(row_number() OVER (PARTITION BY cleaned ORDER BY score DESC, ordinal) AS INTEGER) AS rank,
  score, p_name AS matched_name FROM scored WHERE score > 50 QUALIFY rank <= 5""")
def ontology_five_best(spark, folder):
    """The five best candidates of each text, ties in the order of the ontology."""
    found = ontology.best_candidates(*token_texts(spark, folder), k=5, threshold=50, method="tokens")
    return found.select("cleaned", "rank", "score", "match.matched_name")


@query(f'WITH {NEAR} SELECT "Disease", matched_name, code, "mainType" FROM mapping')
def map_indications(spark, folder):
    return mapping(spark, folder)


@query(f"""WITH {MART} SELECT "Abstract_Number", "Abstract", "Disease", "Genes", "Mapped_Indication", "OncoTree_Code",
  "Main_Type", "Top_Level_Group" FROM mart""")
def mapped_gene_rows(spark, folder):
    return gene_table(spark, folder)


@query(f"""WITH {MART} SELECT DISTINCT "mainType", "Disease" FROM mapping WHERE matched_name IS NOT NULL""")
def group_indications(spark, folder):
    return rollups.group_indications(mapping(spark, folder), "Disease", "mainType")


@query(f"""WITH {MART} SELECT "Abstract_Number", "Genes", "Disease", "Main_Type", "Mapped_Indication", "OncoTree_Code",
  "Top_Level_Group" FROM with_gene""")
def detail_table(spark, folder):
    return filters.detail_table(gene_table(spark, folder))


@query(f"""WITH {MART} SELECT "Genes", "Main_Type", count(*) AS count FROM with_gene
  WHERE "Main_Type" IS NOT NULL GROUP BY ALL""")
def gene_counts(spark, folder):
    return rollups.gene_counts(filters.valid_gene(gene_table(spark, folder)))


MAIN_TYPES = ["economy", "large", "medium", "promo", "small", "standard"]


@query(f"""WITH {MART} SELECT "Genes", {', '.join(f"count(*) FILTER (\"Main_Type\" = '{t}') AS {t}" for t in MAIN_TYPES)}
  FROM with_gene WHERE "Main_Type" IS NOT NULL GROUP BY "Genes" """)
def count_matrix(spark, folder):
    return rollups.count_matrix(filters.valid_gene(gene_table(spark, folder)), values=MAIN_TYPES)


@query("""WITH cells AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
  columns AS (SELECT l_partkey, row_number() OVER (ORDER BY md5(':' || l_partkey), l_partkey) - 1 AS place
    FROM (SELECT DISTINCT l_partkey FROM lineitem))
  SELECT l_suppkey, place // 64 AS block, string_agg((place % 64) || ':' || n, ',' ORDER BY place) AS cells
  FROM cells JOIN columns USING (l_partkey) GROUP BY 1, 2""")
def blocked_matrix(spark, folder):
    """A matrix of suppliers and parts, with more columns than a pivot should have, in blocks of 64."""
    lines = s.table(spark, folder, "lineitem").select("l_suppkey", "l_partkey")
    columns = materialize(rollups.matrix_columns(lines, "l_partkey", 64), "matrix_columns")
    found = rollups.blocked_matrix(lines, columns, "l_suppkey", "l_partkey")
    cells = F.zip_with("positions", "counts", lambda p, n: F.concat_ws(":", p.cast("string"), n.cast("string")))
    return found.select("l_suppkey", "block", F.array_join(cells, ",").alias("cells"))


@query(f"""WITH {MART} SELECT "Genes", "Main_Type", grouping("Genes", "Main_Type")::INTEGER AS level, count(*) AS rows,
  count("Main_Type") AS typed FROM with_gene GROUP BY GROUPING SETS (("Genes", "Main_Type"), ("Genes"), ("Main_Type"))""")
def gene_cube(spark, folder):
    """All counts of the dashboard in one table."""
    return rollups.gene_cube(gene_table(spark, folder))


@query(f"""WITH {MART} SELECT "Genes", {', '.join(f"count(*) FILTER (\"Main_Type\" = '{t}') AS {t}" for t in MAIN_TYPES)},
  count(*) AS total FROM with_gene WHERE "Main_Type" IS NOT NULL GROUP BY "Genes" """)
def cube_matrix(spark, folder):
    """The matrix and the genes' totals, both from the written cube."""
    cube = materialize(rollups.gene_cube(gene_table(spark, folder)), "gene_cube")
    return rollups.cube_matrix(cube, MAIN_TYPES).join(rollups.cube_popular(cube, min_count=1), "Genes")


@query(f"""WITH {MART} SELECT "Main_Type", count(*) AS total, count(DISTINCT "Abstract_Number") AS abstracts
  FROM with_gene WHERE "Main_Type" IS NOT NULL GROUP BY "Main_Type" """)
def type_totals(spark, folder):
    found = filters.valid_gene(gene_table(spark, folder))
    distinct = rollups.type_totals(found, distinct_on="Abstract_Number").withColumnRenamed("total", "abstracts")
    return rollups.type_totals(found).join(distinct, "Main_Type")


@query(f"""WITH {MART} SELECT "Main_Type", count(*) AS total FROM with_gene WHERE "Main_Type" IS NOT NULL
  GROUP BY "Main_Type" ORDER BY total DESC, "Main_Type" LIMIT 1""")
def most_common_type(spark, folder):
    return rollups.most_common_type(rollups.type_totals(filters.valid_gene(gene_table(spark, folder))))


@query(f"""WITH {MART} SELECT "Genes", count(*) AS total FROM with_gene WHERE "Main_Type" IN ('economy', 'small', 'promo')
  GROUP BY "Genes" HAVING count(*) >= 5""")
def popular_genes(spark, folder):
    return rollups.popular_genes(gene_table(spark, folder), ["economy", "small", "promo"], 5)


@query(f"""WITH {MART} SELECT DISTINCT "Main_Type" FROM with_gene""")
def distinct_main_types(spark, folder):
    return rollups.distinct_values(filters.valid_gene(gene_table(spark, folder)), "Main_Type")


@query("""SELECT o_orderkey, c_mktsegment, coalesce(r_name, 'Other Cancer') AS region FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey > 1""")
def mapped_back(spark, folder):
    """A mapping and a grouping joined back to many rows."""
    customers = s.table(spark, folder, "customer").join(
        s.table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    mapped = joins.apply_mapping(
        s.table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")),
        customers.select("c_custkey", "c_mktsegment", "n_regionkey"),
        "c_custkey",
    )
    regions = s.table(spark, folder, "region").filter(F.col("r_regionkey") > 1)
    grouped = joins.top_level_group(mapped, regions, "n_regionkey", "r_regionkey", "r_name", alias="region")
    return grouped.select("o_orderkey", "c_mktsegment", "region")


@query(f"""WITH {MART} SELECT 'popular' AS part, "Genes" AS name, count(*) AS total FROM with_gene
  WHERE "Main_Type" IS NOT NULL GROUP BY "Genes" HAVING count(*) >= 5
UNION ALL SELECT 'totals', "Main_Type", count(*) FROM with_gene WHERE "Main_Type" IS NOT NULL GROUP BY "Main_Type"
UNION ALL SELECT 'indications', "mainType", count(DISTINCT "Disease") FROM mapping WHERE matched_name IS NOT NULL
  GROUP BY "mainType" """)
def gene_mart(spark, folder):
    """Extractions to the tables of the dashboard."""
    tables = mart.gene_mart(
        extractions(spark, folder), tumor_types(spark, folder), groups(spark, folder), method="levenshtein"
    )
    indications = tables["indications"].groupBy("mainType").agg(F.count(F.lit(1)).alias("total"))
    return joins.union_all(
        tables["popular"].select(F.lit("popular").alias("part"), F.col("Genes").alias("name"), "total"),
        tables["totals"].select(F.lit("totals").alias("part"), F.col("Main_Type").alias("name"), "total"),
        indications.select(F.lit("indications").alias("part"), F.col("mainType").alias("name"), "total"),
    )
