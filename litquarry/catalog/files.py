"""Sources and sinks: tables written in each format and read back, and the file stream."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from litquarry import schemas
from litquarry.catalog import chats, ontologies, stand_ins as s
from litquarry.catalog.registry import query
from litquarry.catalog.texts import documents, model
from litquarry.functions.templates import EXTRACTION_PROMPT
from litquarry.operators import chat, extraction, filters
from litquarry.operators.sampling import train_val_split
from litquarry.session import materialize, scratch_path
from litquarry.sources import sinks, tables
from litquarry.streaming import ingest


@query("SELECT l_orderkey AS pmid, l_partkey AS part, l_returnflag AS type FROM lineitem")
def match_files(spark, folder):
    """A folder of match files, read as one table."""
    path = scratch_path(spark, "matches")
    lines = s.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("pmid"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("type")
    )
    sinks.write_table(lines, path)
    return tables.read_matches(spark, path, lines.schema)


@query("""WITH lines AS (SELECT l_orderkey::VARCHAR AS pmid, l_returnflag AS type, l_suppkey % 2 = 0 AS without,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linestatus END AS section, unnest(['batch', 'stream']) AS how FROM lineitem)
  SELECT how, pmid, type FROM lines WHERE type IN ('A', 'R') AND (without OR section = 'F')""")
def section_per_file(spark, folder):
    """Files with and without a section column in one folder, in both orders of their names, as table and as stream."""
    lines = s.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("pmid"), F.lit("text").alias("text"), F.lit("key").alias("keywordId"),
        F.col("l_returnflag").alias("type"), F.array(F.lit("human")).alias("organisms"),
        F.when(F.col("l_linenumber") != 1, F.col("l_linestatus")).alias("section"), "l_suppkey",
    )
    path, streamed = scratch_path(spark, "sections"), scratch_path(spark, "sections")
    bare = lines.filter("l_suppkey % 2 = 0").drop("l_suppkey", "section")
    full = lines.filter("l_suppkey % 2 = 1").drop("l_suppkey")
    for folder_path, first, second in ((path, bare, full), (streamed, full, bare)):
        sinks.write_table(first, f"{folder_path}/a.parquet")
        sinks.write_table(second, f"{folder_path}/b.parquet")
    wanted = lambda matches: filters.literature_filter(matches, s.SECTION, (s.DISEASE, s.GENE))
    batch = wanted(tables.read_matches(spark, [f"{path}/a.parquet", f"{path}/b.parquet"]))
    stream = ingest.ingest_new_files(
        spark, f"{streamed}/*.parquet", scratch_path(spark, "ingested"), scratch_path(spark, "progress"), transform=wanted
    )
    both = batch.withColumn("how", F.lit("batch")).unionByName(stream.withColumn("how", F.lit("stream")))
    return both.select("how", "pmid", "type")


@query("SELECT 'EFO_' || p_partkey AS id, p_name AS name, p_type || '|' || p_brand AS areas FROM part")
def disease_files(spark, folder):
    path = scratch_path(spark, "diseases")
    part = s.table(spark, folder, "part")
    sinks.write_table(
        part.select(
            F.concat(F.lit("EFO_"), "p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.array("p_type", "p_brand").alias("therapeuticAreas"),
            "p_size",
        ),
        path,
    )
    found = tables.read_diseases(spark, path)
    return found.select("id", "name", F.array_join("therapeuticAreas", "|").alias("areas"))


@query(f'WITH {s.SYMBOLS} SELECT "ENSG", "HUGO" FROM symbols')
def symbol_files(spark, folder):
    path = scratch_path(spark, "symbols")
    s.symbol_lines(spark, folder).write.text(path)
    return tables.read_gene_symbols(spark, path)


@query("""SELECT doc_id::VARCHAR AS pmid, source AS title, CASE WHEN lang = 'es' THEN 'No abstract available'
  ELSE replace(text, chr(10), ' ') END AS abstract
  FROM documents""")
def pubmed_files(spark, folder):
    """Articles as XML: several sections, some without abstract, each id twice with the last one complete."""
    path = scratch_path(spark, "pubmed")
    sections = F.struct(F.split("text", "\n").alias("AbstractText"))
    pmid = F.struct(F.col("doc_id").cast("string").alias("_VALUE"), F.lit("1").alias("_Version"))

    def citation(title, abstract):
        article = F.struct(title.alias("ArticleTitle"), abstract.alias("Abstract"))
        return F.struct(pmid.alias("PMID"), article.alias("Article"))

    early = citation(F.lit("early"), F.when(F.lit(False), sections))
    complete = citation(F.col("source"), F.when(F.col("lang") != "es", sections))
    records = s.table(spark, folder, "documents").select(F.explode(F.array(early, complete)).alias("MedlineCitation"))
    records.write.format("xml").option("rootTag", "PubmedArticleSet").option("rowTag", "PubmedArticle").save(path)
    return tables.read_pubmed_xml(spark, path)


@query("SELECT doc_id::VARCHAR AS doc_id, 0 AS page_no, text FROM documents")
def page_files(spark, folder):
    path = scratch_path(spark, "pages")
    docs = s.table(spark, folder, "documents")
    pages = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("page_no"), "text")
    sinks.write_table(pages, path)
    return tables.read_pages(spark, path)


@query("""SELECT doc_id, text AS abstract, source AS disease, NULL::VARCHAR AS genes FROM documents""")
def csv_files(spark, folder):
    """Texts with newlines, quotes and commas, and the missing-value text, through CSV."""
    path = scratch_path(spark, "csv")
    docs = s.table(spark, folder, "documents")
    sinks.write_csv_table(
        docs.select("doc_id", F.col("text").alias("abstract"), F.col("source").alias("disease"), F.lit("n/a").alias("genes")),
        path,
    )
    return tables.read_csv_table(spark, path, "doc_id bigint, abstract string, disease string, genes string")


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT doc_id, abstract, disease_name, gene FROM labelled""")
def jsonl_files(spark, folder):
    path = scratch_path(spark, "jsonl")
    rows = s.labelled_documents(spark, folder)
    sinks.write_jsonl(rows, path)
    return tables.read_jsonl(spark, path, rows.schema).drop("raw", "malformed")


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT
  replace('{EXTRACTION_PROMPT}', '[[[abstract]]]', abstract) AS user_text, 2 AS n_messages
  FROM labelled WHERE abstract <> chr(32) || chr(9)""")
def chat_files(spark, folder):
    path = scratch_path(spark, "chat")
    built = chat.build_chat(s.labelled_documents(spark, folder), EXTRACTION_PROMPT)
    sinks.write_chat_lines(built, path, "doc_id")
    read = tables.read_chat_lines(spark, path)
    return read.select(
        F.col("messages")[0]["content"].alias("user_text"), F.size("messages").alias("n_messages")
    )


SPLIT = """split_documents AS (SELECT doc_id, text, md5('123:' || doc_id) AS h, CASE WHEN row_number() OVER (ORDER BY md5('123:' || doc_id), doc_id)
  <= floor(0.95::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split FROM documents)"""


def exported_splits(spark, folder):
    """Documents as one-message samples, split and exported; the path of the files."""
    path = scratch_path(spark, "splits")
    message = F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"))
    split = train_val_split(s.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    samples = split.select(
        "doc_id", "split", F.array(message).alias("messages"),
        F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string")).alias("rest"),
    )
    sinks.export_splits(samples, path, "doc_id")
    return path


@query(f"WITH {SPLIT} SELECT text, doc_id::VARCHAR AS doc_id, split FROM split_documents")
def split_files(spark, folder):
    """Train and validation splits exported as JSON lines and reloaded."""
    read = tables.read_splits(spark, exported_splits(spark, folder))
    return read.select(F.col("messages")[0]["content"].alias("text"), F.col("rest")["doc_id"].alias("doc_id"), "split")


@query(f"""WITH {SPLIT} SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY h, doc_id) AS position
  FROM split_documents""")
def exported_order(spark, folder):
    """The place of each exported row in its split's files, in name order: the seeded shuffle.

    Lines are numbered within the parts of files that tasks read, and these parts by their first place.
    """
    lines = spark.read.text(exported_splits(spark, folder)).select(
        "split", F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    part = ["split", "file", "start"]
    numbered = lines.withColumn("place", F.row_number().over(Window.partitionBy(*part).orderBy("line")))
    before = Window.partitionBy("split").orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lines.groupBy(*part).count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    return numbered.join(offsets, part).select("doc_id", "split", (F.col("before") + F.col("place")).alias("position"))


@query(f"""WITH {chats.REPAIRED}, kept AS (SELECT doc_id, last, CASE WHEN row_number() OVER (ORDER BY md5('123:' || doc_id), doc_id)
  <= floor(0.95::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split FROM state WHERE status = 'kept')
SELECT doc_id::VARCHAR AS doc_id, split, '{{"function":{{"name":"tool"}}}}' AS tool, (SELECT string_agg(message || ';' || i, chr(10) ORDER BY i)
    FROM messages m WHERE m.doc_id = kept.doc_id AND i <= last) AS body, len(string_split(
    (SELECT string_agg(message, chr(10) ORDER BY i) FROM messages m WHERE m.doc_id = kept.doc_id AND i <= last), chr(10))) AS n_lines
FROM kept""")
def tool_split_files(spark, folder):
    """Repaired tool samples exported per split and reloaded: calls, ids, names, texts, tools and unknown fields."""
    path = scratch_path(spark, "tool_splits")
    samples = chats.tool_samples(spark, folder)
    place = lambda m, i: m.withField("rest", F.create_map(F.lit("place"), i.cast("string")))
    marked = chat.full_messages(samples).withColumn("messages", F.transform("messages", place)).withColumn(
        "rest", F.create_map(F.lit("doc"), F.col("doc_id").cast("string"))
    )
    repaired = materialize(chat.repair_chat(marked, "doc_id"), "repaired")
    sinks.export_splits(train_val_split(repaired, "doc_id"), path, "doc_id")
    read = tables.read_splits(spark, path)
    flat = F.transform("messages", lambda m: F.concat_ws(";", chats.flat_message(m), m["rest"]["place"]))
    body = F.array_join(flat, "\n")
    return read.select(
        F.col("rest")["doc"].alias("doc_id"), "split", F.col("tools")[0].alias("tool"), body.alias("body"),
        F.size(F.split(body, "\n")).cast("bigint").alias("n_lines"),
    )


@query(f'WITH {ontologies.ROWS} SELECT * FROM gene_rows')
def json_array_files(spark, folder):
    """Extractions exported twice as JSON arrays in several parts, and read back as extractions."""
    paths = [scratch_path(spark, "array"), scratch_path(spark, "array")]
    sinks.write_json_array(ontologies.extractions(spark, folder).repartition(4, "abstract"), *paths)
    rows = extraction.explode_genes(tables.read_extractions(spark, paths[1]))
    return filters.drop_if_all_null(rows, ["Disease", "Genes"])


@query(f'WITH {ontologies.ROWS} SELECT * FROM gene_rows')
def extraction_files(spark, folder):
    """Extractions with polymorphic genes through JSON."""
    path = scratch_path(spark, "extractions")
    ontologies.extractions(spark, folder).write.json(path)
    rows = extraction.explode_genes(tables.read_extractions(spark, path, lines=True))
    return filters.drop_if_all_null(rows, ["Disease", "Genes"])


@query(f'WITH {ontologies.TUMORS} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, name, code, "mainType" FROM tumors')
def ontology_files(spark, folder):
    """The ontology as JSON array documents in order, read in parts; the position is kept."""
    path = scratch_path(spark, "ontology")
    types = ontologies.tumor_types(spark, folder).orderBy("ordinal")
    sinks.write_json_array(types.select(*schemas.TUMOR_TYPES.names), path)
    return tables.read_ontology(spark, path, layout="lines")


@query(f'WITH {ontologies.TUMORS} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, name, code, "mainType" FROM tumors')
def indented_array_files(spark, folder):
    """The ontology as indented JSON arrays of fifty elements, cut between their elements wherever a block begins."""
    path, row = scratch_path(spark, "ontology"), F.struct(*schemas.TUMOR_TYPES.names)
    types = ontologies.tumor_types(spark, folder).withColumn("part", F.lpad(F.floor(F.col("ordinal") / 50), 9, "0"))
    texts = types.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.to_json(row, {"ignoreNullFields": "false"}).alias("text")))).alias("all"))
    texts = texts.select("part", F.array_join(F.transform("all", lambda x: F.regexp_replace(x["text"], r"^\{|\}$", "")), "\n  },\n  {\n    ").alias("body"))
    texts.select("part", F.concat(F.lit("[\n  {\n    "), "body", F.lit("\n  }\n]"))).write.partitionBy("part").text(path)
    return tables.read_ontology(spark, path, layout=2)


@query("""SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R')""")
def incremental_ingest(spark, folder):
    """Line items as a file stream, filtered into a table; a second run finds nothing new."""
    out, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "progress")
    schema = s.table(spark, folder, "lineitem").schema

    def wanted(lines):
        return filters.literature_filter(
            lines, s.SECTION, (s.DISEASE, s.GENE), "l_linestatus", "l_returnflag",
            ["l_orderkey", "l_partkey", "l_returnflag"],
        )

    for _ in range(2):
        found = ingest.ingest_new_files(
            spark, folder, out, checkpoint, schema=schema, pattern="lineitem.parquet", transform=wanted
        )
    return found


@query("""SELECT 4 AS files, count(*) AS rows_in, count(*) FILTER (l_linestatus = 'F' AND l_returnflag IN ('A', 'R')) AS rows_kept
  FROM lineitem""")
def ingest_totals(spark, folder):
    """Files and rows of two runs of an ingest: two files of line items in each, one file a batch."""
    src, out, checkpoint, totals = (scratch_path(spark, n) for n in ("arrivals", "ingested", "progress", "totals"))
    lines = s.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("pmid"), F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("section")
    )
    wanted = lambda matches: filters.literature_filter(matches, s.SECTION, (s.DISEASE, s.GENE), columns=["pmid", "type"])
    for run in range(2):
        for part in (2 * run, 2 * run + 1):
            sinks.write_table(lines.filter(F.pmod(F.xxhash64("pmid"), F.lit(4)) == part).repartition(1), f"{src}/{part}.parquet")
        ingest.ingest_new_files(
            spark, f"{src}/*.parquet", out, checkpoint, lines.schema, files_per_batch=1, transform=wanted, totals=totals
        )
    return ingest.ingest_totals(spark, totals)


@query("""SELECT doc_id, CASE WHEN contains(text, '@') THEN 'Error querying model'
  ELSE '{"Disease": "n/a", "Genes": "' || length(text) || '"}' END AS response FROM documents""")
def saved_answers(spark, folder):
    """Prompts answered as a file stream; the second run finds all of them answered."""
    src, out, checkpoint = (scratch_path(spark, name) for name in ("prompts", "answers", "progress"))
    prompts = documents(spark, folder)
    sinks.write_table(prompts, src)
    for _ in range(2):
        found = ingest.answer_new_prompts(spark, src, out, checkpoint, model(), prompts.schema, "text")
    return found.select("doc_id", "response")
