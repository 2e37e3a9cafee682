"""Sources: each gives a DataFrame with a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from litquarry import schemas
from litquarry.functions.answers import STRICT_JSON, is_json_object, other_fields
from litquarry.functions.binding import bind
from litquarry.functions.text import MISSING, join_sections
from litquarry.operators.filters import clean_gene_symbols
from litquarry.operators.joins import union_all
from litquarry.session import materialize

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_matches(spark: SparkSession, path: str | list[str], schema: T.StructType | str = schemas.MATCHES) -> DataFrame:
    """Literature matches of all Parquet files under the path; no such file is an error.

    Files without the suffix are ignored. The schema is declared, so it does not depend on
    which file is looked at first; `section` is optional file by file, and matches of a
    file without it have ``NO_SECTION`` there.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
    if names.select("path").isEmpty():
        raise ValueError(f"no Parquet files under {paths}")
    return spark.read.option("pathGlobFilter", "*.parquet").schema(schema).parquet(*paths)


def union_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows of the files that exist; their columns must agree. None at all is an error."""
    found = []
    for path in paths:
        try:
            found.append(spark.read.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise ValueError("none of the paths exists")
    return union_all(*found)


def read_diseases(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", "*.parquet").schema(schemas.DISEASES)
    return reader.parquet(path)


def read_gene_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Gene identifiers and symbols from a tab-separated file without header.

    Read as lines, so that a line with more or fewer fields can be told apart.
    """
    return clean_gene_symbols(spark.read.text(path))


def read_pubmed_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per article: pmid, title, abstract. The last record of a repeated id counts."""
    reader = spark.read.format("xml").option("rowTag", "PubmedArticle").option("ignoreSurroundingSpaces", "false")
    articles = reader.schema(schemas.PUBMED_ARTICLE).load(path)
    citation = F.col("MedlineCitation")
    records = articles.select(
        citation["PMID"]["_VALUE"].alias("pmid"),
        citation["Article"]["ArticleTitle"].alias("title"),
        join_sections(citation["Article"]["Abstract"]["AbstractText"]).alias("abstract"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    placed = _placed(materialize(records, "articles"))
    last = placed.groupBy(F.col("pmid").alias("_pmid")).agg(F.max("_position").alias("_last"))
    chosen = placed.join(last, F.col("pmid").eqNullSafe(F.col("_pmid")) & (F.col("_position") == F.col("_last")))
    return chosen.select("pmid", "title", "abstract")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their `_position`: a number in the order of file names, places in files and rows.

    Only the parts of files are put in order, one row each; the records themselves stay where they are.
    """
    first = rows.groupBy("_file", "_start").agg(F.min("_at").alias("_first"))
    number = F.row_number().over(Window.orderBy("_file", "_start")).cast("bigint") - 1
    parts = first.withColumn("_number", number)
    position = F.shiftleft("_number", 33) + F.col("_at") - F.col("_first")
    return rows.join(parts, ["_file", "_start"]).withColumn("_position", position)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page texts from Parquet (doc_id, page_no, text), or one page per text file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if not files.select("path").isEmpty():
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("doc_id"), F.lit(0).alias("page_no"), F.col("value").alias("text")
    )


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, layout: str | int) -> DataFrame:
    """`position`, from 0, and `element`, a struct, of JSON arrays of objects that are laid out for splitting.

    ``layout`` is ``"lines"`` for arrays with one element on a line, as ``write_json_array`` makes them, or the
    number of spaces of an indented document, whose elements are the objects at the first indent. No
    JSON text has a line break in a string, so both kinds of separators are certain, and Spark
    reads one file by many tasks. An element that is not exactly one JSON object is an error;
    documents of any other layout are read as a whole by ``read_extractions`` and ``read_ontology``.
    Positions go on from one document to the next, in the order of their names.
    """
    if layout == "lines":
        rows = spark.read.text(path)
        element = F.regexp_replace(F.regexp_replace("value", r"^\s*\[?\s*", ""), r"\s*[,\]]?\s*$", "")
        kept = element != ""
    else:
        pad = " " * int(layout)
        rows = spark.read.text(path, lineSep=f"\n{pad}}},\n{pad}{{")
        body = F.regexp_replace("value", r"^\s*\[\s*\{|\}\s*\]\s*$", "")
        element = F.concat(F.lit("{"), body, F.lit("}"))
        kept = ~F.col("value").rlike(r"^\s*(\[\s*\]\s*)?$")
    placed = rows.filter(kept).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), element.alias("_text"),
    )
    wrong = F.raise_error(F.concat(F.lit("no JSON object: "), F.left("_text", F.lit(200))))
    checked = F.when(is_json_object(F.col("_text")), F.from_json("_text", schema, STRICT_JSON)).otherwise(wrong)
    parts = placed.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_file", "_start", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.join(parts, ["_file", "_start"]).select(position.alias("position"), checked.alias("element"))


def read_extractions(spark: SparkSession, path: str, lines: bool = False, layout: str | int | None = None) -> DataFrame:
    """Extraction results from JSON arrays, or with ``lines`` from JSON lines.

    Spark splits JSON lines, and arrays whose ``layout`` is told; an array of any layout is read by one task.
    """
    if layout is not None:
        return read_json_array(spark, path, schemas.EXTRACTIONS, layout).select("element.*")
    return spark.read.schema(schemas.EXTRACTIONS).json(path, multiLine=not lines)


def read_ontology(spark: SparkSession, path: str, layout: str | int | None = None) -> DataFrame:
    """Tumour types of a JSON array document, with their position in it, from 0, as `ordinal`.

    A document whose ``layout`` is told, see ``read_json_array``, is read by many tasks. Several documents
    count in the order of their names: with a layout on from one to the next, else each from a number of its own on.
    """
    names = schemas.TUMOR_TYPES.names
    if layout is not None:
        return read_json_array(spark, path, schemas.TUMOR_TYPES, layout).select(F.col("position").alias("ordinal"), "element.*")
    rows = spark.read.schema(schemas.TUMOR_TYPES).json(path, multiLine=True).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), *names,
    )
    return _placed(rows).select(F.col("_position").alias("ordinal"), *names)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header, quoted newlines and doubled quotes; the missing-value text reads as null."""
    return spark.read.schema(schema).csv(path, nullValue=MISSING, **CSV_OPTIONS)


def _json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a text as `raw`; `malformed` where a line is not exactly one JSON object."""
    line = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    columns = [F.col("value").alias("raw"), (~is_json_object(F.col("value"))).alias("malformed")]
    columns += [F.col("split")] if "split" in line.columns else []
    return line.select(*columns)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str = schemas.CHAT_SAMPLE) -> DataFrame:
    """JSON lines with the declared fields, `raw` and `malformed`; a malformed line has null fields."""
    row = F.when(~F.col("malformed"), F.from_json("raw", schema, STRICT_JSON))
    return _json_lines(spark, path).select(row.alias("_row"), "raw", "malformed").select("_row.*", "raw", "malformed")


def read_chat_lines(spark: SparkSession, path: str) -> DataFrame:
    """Chat samples of JSON lines: messages, functions, tools, rest, raw and malformed.

    Sample, messages and calls keep fields that are not declared in `rest`, by name and as
    JSON texts; functions and tools are JSON texts. A folder of splits gives `split` too.
    """

    def call(text):
        return _with_rest(text, schemas.TOOL_CALL)

    def message(text):
        calls = F.from_json(text, "tool_calls array<string>", STRICT_JSON)["tool_calls"]
        return bind(
            _with_rest(text, schemas.MESSAGE),
            lambda m: F.struct(*[
                (F.transform(calls, call) if f == "tool_calls" else m[f]).alias(f) for f in schemas.FULL_MESSAGE.names
            ]),
        )

    lines = _json_lines(spark, path)
    parts = F.from_json("raw", "messages array<string>, functions array<string>, tools array<string>", STRICT_JSON)
    parsed = lines.withColumn("_parts", F.when(~F.col("malformed"), parts))
    return parsed.select(
        F.transform("_parts.messages", message).alias("messages"), "_parts.functions", "_parts.tools",
        F.when(~F.col("malformed"), other_fields(F.col("raw"), schemas.CHAT_SAMPLE.names)).alias("rest"),
        *[c for c in lines.columns],
    )


def _with_rest(text, schema: T.StructType):
    """The declared fields of a JSON object and the others as `rest`."""
    return bind(
        F.from_json(text, schema, STRICT_JSON),
        lambda known: F.struct(*[known[f].alias(f) for f in schema.names], other_fields(text, schema.names).alias("rest")),
    )


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """Splits written by ``export_splits``, with their name as `split`."""
    return read_chat_lines(spark, path)
