"""Column functions over texts, answers and their parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from litquarry.catalog import stand_ins as s
from litquarry.catalog.registry import query
from litquarry.functions import answers, text
from litquarry.functions.templates import EXTRACTION_PROMPT
from litquarry.operators import answer_store, extraction, filters
from litquarry.plans.extraction import extract_from_pages
from litquarry.session import scratch_path

HEADER = "[A-Z][a-z]+[.] "

TRIM = f"'{text.WHITESPACE}'"


def quoted(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def ascii_sql(column: str) -> str:
    """SQL of a text's JSON form in ASCII, without the quotes."""
    body = (
        f"replace(replace(replace(replace(replace({column}, '\\', '\\\\'), '\"', '\\\"'), "
        "chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    )
    return f"""array_to_string(list_transform(string_split({body}, ''), lambda c: CASE
      WHEN unicode(c) BETWEEN 32 AND 126 THEN c
      WHEN unicode(c) < 65536 THEN printf('\\u%04X', unicode(c))
      ELSE printf('\\u%04X\\u%04X', 55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024)
      END), '')"""


def clean_sql(column: str) -> str:
    return f"""coalesce(trim(lower(regexp_replace(regexp_replace(trim(string_split({column}, ',')[1], {TRIM}),
      '\\([^)]*\\)', '', 'g'), '[^a-zA-Z0-9{text.WHITESPACE}]', '', 'g')), {TRIM}), '')"""


def documents(spark, folder):
    return s.table(spark, folder, "documents").select("doc_id", "text")


@query(f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents")
def clean_indication(spark, folder):
    return documents(spark, folder).select("doc_id", text.clean_indication("text").alias("cleaned"))


@query("""SELECT o_orderkey, nullif(regexp_extract(o_orderpriority, '^(\\d+)', 1), '') AS leading,
  nullif(regexp_extract(o_orderstatus, '^(\\d+)', 1), '') AS none FROM orders""")
def abstract_number(spark, folder):
    return s.table(spark, folder, "orders").select(
        "o_orderkey",
        text.abstract_number("o_orderpriority").alias("leading"),
        text.abstract_number("o_orderstatus").alias("none"),
    )


PIECES = f"""marked AS (SELECT doc_id, string_split(
    regexp_replace(text, '({HEADER})', chr(57344) || '\\1', 'g'), chr(57344))[2:] AS pieces FROM documents),
pieces AS (SELECT doc_id, unnest(range(len(pieces)))::INT AS piece_no, trim(unnest(pieces), {TRIM}) AS "Abstract"
  FROM marked)"""


@query(f'WITH {PIECES} SELECT doc_id, piece_no, "Abstract" FROM pieces')
def split_at_headers(spark, folder):
    return extraction.split_at_headers(documents(spark, folder), "text", HEADER)


@query(f"""WITH joined AS (SELECT doc_id // 5 AS doc, string_agg(text, chr(10) ORDER BY doc_id) AS text FROM documents GROUP BY 1),
  cut AS (SELECT doc, string_split(regexp_replace(text, '({HEADER})', chr(57344) || '\\1', 'g'), chr(57344))[2:] AS pieces FROM joined)
  SELECT doc, unnest(range(len(pieces)))::INT AS piece_no, trim(unnest(pieces), {TRIM}) AS "Abstract" FROM cut""")
def split_across_pages(spark, folder):
    """Five documents as the pages of one: a piece goes on to the next header, on whichever page that is."""
    pages = documents(spark, folder).select(F.floor(F.col("doc_id") / 5).alias("doc"), F.col("doc_id").alias("page"), "text")
    return extraction.split_at_headers(pages, "text", HEADER, across_pages=True, doc="doc", page="page")


PAGE_CHARS = 40


@query(f'WITH {PIECES} SELECT doc_id, piece_no, "Abstract" FROM pieces')
def split_at_cut_headers(spark, folder):
    """Documents cut to pages of a few characters, so that headers are cut at every place."""
    cut = F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PAGE_CHARS}}}"), F.lit(0)))
    pages = documents(spark, folder).select("doc_id", cut.alias("page", "text"))
    return extraction.split_at_headers(pages, "text", HEADER, across_pages=True, page="page", between="")


@query(f"""WITH shown AS (SELECT doc_id // 5 AS doc, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 5) // 2 END AS page, text FROM documents
    UNION ALL SELECT doc_id // 5, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 5) // 2 END, text FROM documents WHERE doc_id % 7 = 0),
  known AS (SELECT * FROM shown QUALIFY count(DISTINCT text) OVER (PARTITION BY doc, page) = 1),
  joined AS (SELECT doc, string_agg(text, chr(10) ORDER BY page NULLS FIRST) AS text FROM known GROUP BY 1),
  cut AS (SELECT doc, string_split(regexp_replace(text, '({HEADER})', chr(57344) || '\\1', 'g'), chr(57344))[2:] AS pieces FROM joined)
  SELECT doc, unnest(range(len(pieces)))::INT AS piece_no, trim(unnest(pieces), {TRIM}) AS "Abstract" FROM cut""")
def split_across_repeated_pages(spark, folder):
    """Pages without a number come first, and a page that is there twice counts twice."""
    number = F.when(F.col("doc_id") % 3 > 0, F.floor(F.col("doc_id") % 5 / 2))
    shown = documents(spark, folder).select(F.floor(F.col("doc_id") / 5).alias("doc"), number.alias("page"), "text", "doc_id")
    shown = shown.unionByName(shown.filter("doc_id % 7 = 0")).drop("doc_id")
    alone = shown.groupBy("doc", "page").agg(F.count_distinct("text").alias("n")).filter("n = 1")
    pages = shown.alias("s").join(alone.alias("a"), F.expr("s.doc = a.doc and s.page <=> a.page"), "left_semi")
    return extraction.split_at_headers(pages, "text", HEADER, across_pages=True, doc="doc", page="page")


@query(f"""SELECT doc_id, trim(chr(160) || text || chr(9), {TRIM}) AS stripped,
  array_to_string(string_split(text, chr(10)), ' ') AS joined FROM documents""")
def strip_and_join(spark, folder):
    return documents(spark, folder).select(
        "doc_id",
        text.strip(F.concat(F.lit("\xa0"), "text", F.lit("\t"))).alias("stripped"),
        text.join_sections(F.split("text", "\n")).alias("joined"),
    )


@query(f"WITH {s.LABELLED_DOCUMENTS} SELECT * FROM labelled WHERE abstract <> chr(32) || chr(9)")
def drop_blank(spark, folder):
    return filters.drop_blank(s.labelled_documents(spark, folder), "abstract")


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT doc_id, coalesce(disease_name, 'n/a') AS disease,
  CASE WHEN gene IS NOT NULL THEN gene END AS gene FROM labelled""")
def missing_values(spark, folder):
    """Null to text and back."""
    return s.labelled_documents(spark, folder).select(
        "doc_id",
        text.null_to_na("disease_name").alias("disease"),
        text.na_to_null(text.null_to_na("gene")).alias("gene"),
    )


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT doc_id, disease_name, gene FROM labelled
  WHERE disease_name IS NOT NULL OR gene IS NOT NULL""")
def drop_if_all_null(spark, folder):
    rows = s.labelled_documents(spark, folder).select("doc_id", "disease_name", "gene")
    return filters.drop_if_all_null(rows, ["disease_name", "gene"])


@query(f"SELECT doc_id, replace({quoted(EXTRACTION_PROMPT)}, '[[[abstract]]]', text) AS prompt FROM documents")
def render_prompt(spark, folder):
    return documents(spark, folder).select("doc_id", text.render_prompt(EXTRACTION_PROMPT, "text").alias("prompt"))


@query(f"""SELECT doc_id, '{{"Disease": "' || {ascii_sql('text')} || '", "Genes": "' || source || '"}}' AS answer
  FROM documents""")
def encode_answer(spark, folder):
    rows = s.table(spark, folder, "documents")
    return rows.select("doc_id", answers.encode_answer("text", "source").alias("answer"))


def responses(spark, folder):
    """Valid objects with each shape of genes, and texts that are no JSON object."""
    event = F.col("event_type")
    return s.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("Abstract"),
        F.when(event == "view", F.concat(F.lit('{"Disease": "user '), "user_id", F.lit('", "Genes": ["A", "B"]}')))
        .when(event == "click", F.concat(F.lit(' {"Genes": "A, B", "Disease": null, "comment": "'), "value", F.lit('"}\n')))
        .when(event == "error", F.concat("props", F.lit(" trailing")))
        .when(event == "signup", F.concat(F.lit("["), "props", F.lit("]")))
        .otherwise(F.col("props"))
        .alias("response"),
    )


RESPONSES = """responses AS (SELECT event_id::VARCHAR AS "Abstract", event_type, user_id, CASE event_type
  WHEN 'view' THEN '{"Disease": "user ' || user_id || '", "Genes": ["A", "B"]}'
  WHEN 'click' THEN ' {"Genes": "A, B", "Disease": null, "comment": "' || value || '"}' || chr(10)
  WHEN 'error' THEN props || ' trailing' WHEN 'signup' THEN '[' || props || ']' ELSE props END AS response
  FROM events)"""


@query(f"""WITH {RESPONSES} SELECT "Abstract" AS abstract, response::JSON ->> 'Disease' AS "Disease",
  CAST(response::JSON -> 'Genes' AS VARCHAR) AS "Genes", response::JSON ->> 'comment' AS comment, response
  FROM responses WHERE event_type IN ('view', 'click', 'purchase')""")
def parse_responses(spark, folder):
    parsed = extraction.parse_responses(responses(spark, folder))
    return parsed.withColumn("Genes", F.to_json("Genes"))


@query("""SELECT event_id, 'u' || user_id AS "Disease", '["' || event_type || '"]' AS "Genes" FROM events""")
def repeated_keys(spark, folder):
    """Responses with repeated keys: the last one counts, and those of other fields change nothing."""
    response = F.concat(
        F.lit('{"Genes": "A", "Disease": "early", "x": {"a": 1, "a": 2}, "Disease": "u'), "user_id", F.lit('", "Genes": ["'), "event_type", F.lit('"]}')
    )
    rows = s.table(spark, folder, "events").select(F.col("event_id").alias("Abstract"), response.alias("response"))
    return extraction.parse_responses(rows).select(F.col("abstract").alias("event_id"), "Disease", F.to_json("Genes").alias("Genes"))


@query(f"""WITH {RESPONSES} SELECT "Abstract", response FROM responses WHERE event_type IN ('error', 'signup')""")
def rejected_responses(spark, folder):
    return extraction.rejected_responses(responses(spark, folder))


@query(f"""SELECT doc_id, nullif(trim(unnest(string_split(text, ',')), {TRIM}), '') AS gene FROM documents""")
def split_gene_text(spark, folder):
    """A comma text as genes, one row each."""
    rows = documents(spark, folder).withColumn("genes", F.parse_json(answers.json_text("text")))
    return rows.select("doc_id", F.explode(extraction.gene_list(F.col("genes"))).alias("gene"))


def model():
    """A stand-in for a model: fails on an e-mail sign, else answers with the length."""

    def answer(prompt):
        if "@" in prompt:
            raise ValueError("refused")
        return f'{{"Disease": "n/a", "Genes": "{len(prompt)}"}}'

    return answer


@query("""SELECT doc_id, CASE WHEN contains(text, '@') THEN 'Error querying model'
  ELSE '{"Disease": "n/a", "Genes": "' || length(text) || '"}' END AS response FROM documents""")
def extract_batch(spark, folder):
    return extraction.extract_batch(documents(spark, folder), model(), "text").select("doc_id", "response")


@query("""SELECT doc_id, CASE WHEN contains(text, '@') OR length(text) % 2 = 1 THEN 'second ' ELSE 'first ' END || length(text) AS response
  FROM documents""")
def resumed_answers(spark, folder):
    """A run in which many calls fail, and one that goes on from its answers and asks for the others only."""

    def flaky(prompt):
        if "@" in prompt or len(prompt) % 2:
            raise ConnectionError("no answer")
        return f"first {len(prompt)}"

    store, prompts = scratch_path(spark, "answer_store"), documents(spark, folder)
    answer_store.ask_missing(prompts, flaky, store, "text", per_round=300)
    found = answer_store.resume_answers(prompts, lambda prompt: f"second {len(prompt)}", store, "text", per_round=300)
    return found.select("doc_id", "response")


@query(f"""WITH {PIECES} SELECT "Abstract" AS abstract, 'n/a' AS "Disease",
  '"' || (length("Abstract") + {len('Text: ')}) || '"' AS "Genes" FROM pieces WHERE NOT contains("Abstract", '@')""")
def page_extraction(spark, folder):
    """Pages to parsed extractions: segments, prompts, answers, strict parsing."""
    found = extract_from_pages(documents(spark, folder), "Text: [[[abstract]]]", model(), "text", HEADER)
    return found.select("abstract", "Disease", F.to_json("Genes").alias("Genes"))
