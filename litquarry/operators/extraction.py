"""Answers for prompts, and the gene rows they hold."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from litquarry.functions.answers import strict_object
from litquarry.functions.binding import bind, keep_where
from litquarry.functions.text import MISSING, SESSION_HEADER, abstract_number, header_pieces, marked_pieces, na_to_null, strip
from litquarry.session import materialize

# Fixed value: the response of a row whose answer function failed.
QUERY_ERROR = "Error querying model"

HEADER_CHARS = 200
"""Characters a header may have that is cut by the end of a page."""
SHEET_CHARS = 1 << 15
"""Characters of neighbouring short pages that are put together before headers are looked for."""


def split_at_headers(
    df: DataFrame, text: str = "text", header: str = SESSION_HEADER, alias: str = "Abstract", across_pages: bool = False,
    doc: str = "doc_id", page: str = "page_no", between: str = "\n",
) -> DataFrame:
    """One row per piece of the text, with its position from 0.

    Pieces end with their page, or with ``across_pages`` at the next header of their document:
    rows are then (doc, piece_no, piece), see ``pieces_across_pages``.
    """
    if across_pages:
        return pieces_across_pages(df, text, header, alias, doc, page, between)
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(header_pieces(text, header)).alias("piece_no", alias))


def pieces_across_pages(
    df: DataFrame, text: str = "text", header: str = SESSION_HEADER, alias: str = "Abstract", doc: str = "doc_id", page: str = "page_no",
    between: str = "\n", header_chars: int = HEADER_CHARS,
) -> DataFrame:
    """(doc, piece_no, piece) of the pieces of each document's pages, joined with ``between``.

    Pages follow their number, null first; pages with the same number follow a hash of their text,
    and repeated pages all count. A null text is an empty page; pages with a null document are one
    document. A header may be cut by the ends of pages anywhere, if it has at most
    ``header_chars`` characters; one that begins inside another is none.

    Short pages are first put together to sheets, see ``_sheets``; a sheet or a long page is a page
    from then on. Every page has a row number, and only the short ends of pages are put in order: a page learns what
    follows it, and how much of its own beginning belongs to a header of an earlier page. Headers
    are then found page by page and numbered over a document from their counts, and only the parts
    of one piece come together in a row.
    """
    columns = [F.col(doc).alias("doc"), F.col(page).alias("page"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    pages = _sheets(materialize(df.select(*columns, F.monotonically_increasing_id().alias("row")), "pages"), between, 3 * header_chars)
    order = Window.partitionBy("doc").orderBy(F.col("page").asc_nulls_first(), "hash", "row")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = pages.select(
        "doc", "page", "row", F.xxhash64("text").alias("hash"), F.length("text").cast("long").alias("size"),
        F.left("text", F.lit(header_chars)).alias("head"), F.right("text", F.lit(2 * header_chars)).alias("tail"),
    )
    start = F.coalesce(F.sum(F.col("size") + len(between)).over(before), F.lit(0))
    placed = ends.select(
        "doc", "row", "tail", F.row_number().over(order).alias("place"), start.alias("start"), (start + F.col("size")).alias("end"),
        F.concat(F.lit(between), F.lead("head").over(order)).alias("next"),
    )
    near = Window.partitionBy("doc").orderBy("end").rangeBetween(0, header_chars - 1)
    ahead = placed.withColumn("ahead", F.left(F.array_join(F.collect_list("next").over(near), ""), F.lit(header_chars)))
    reach = ahead.withColumn("reach", F.col("end") + _spill(F.col("tail"), F.col("ahead"), header))
    taken = F.max("reach").over(Window.partitionBy("doc").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    skip = F.greatest(F.lit(0), F.coalesce(taken - F.col("start"), F.lit(0))).cast("int")
    joints = materialize(reach.select("row", "place", "ahead", skip.alias("skip")), "page_joints")

    parts = _parts_of_page(F.col("text"), F.col("skip"), F.col("ahead"), header)
    cut = materialize(pages.select("doc", "row", "text").join(joints, "row").select("doc", "row", "place", parts.alias("parts")), "page_parts")
    counts = cut.select("row", "doc", "place", (F.size("parts") - 1).alias("headers"))
    earlier = Window.partitionBy("doc").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.select("row", F.coalesce(F.sum("headers").over(earlier), F.lit(0)).alias("before"))
    pieces = cut.join(numbered, "row").select("doc", "place", "before", F.posexplode("parts").alias("at", "part"))
    number = (F.col("before") + F.col("at") - 1).cast("int")
    grouped = pieces.withColumn("piece_no", number).filter("piece_no >= 0").groupBy("doc", "piece_no").agg(
        F.array_sort(F.collect_list(F.struct("place", "part"))).alias("found")
    )
    joined = strip(F.array_join(F.transform("found", lambda p: p["part"]), between))
    return grouped.select(F.col("doc").alias(doc), "piece_no", joined.alias(alias))


def _sheets(pages: DataFrame, between: str, short: int) -> DataFrame:
    """Pages (doc, page, text, row) of the same texts, runs of pages of up to ``short`` characters being joined to one.

    ``page`` is then the place of a run's first page and ``row`` one of its rows, and no run has more than SHEET_CHARS
    characters, an empty page counting as one, and those of one short page, so that a page of few characters costs no row of its own later on. Only short texts
    are put in order; a long page stays where it is and learns its place.
    """
    size = F.length("text").cast("long")
    order = Window.partitionBy("doc").orderBy(F.col("page").asc_nulls_first(), "hash", "row")
    start = F.sum(F.greatest(F.col("size") + len(between), F.lit(1))).over(order)
    longs = F.sum(F.when(F.col("own").isNull(), 1).otherwise(0)).over(order)
    own = F.when(size <= short, F.col("text"))
    thin = pages.select("doc", "page", "row", F.xxhash64("text").alias("hash"), F.when(own.isNotNull(), size).otherwise(0).alias("size"), own.alias("own"))
    placed = thin.select(
        "doc", "row", "own", F.row_number().over(order).alias("place"), longs.alias("longs"), F.floor(start / SHEET_CHARS).alias("sheet"),
    )
    run = F.when(F.col("own").isNull(), -1).otherwise(F.col("sheet")).alias("sheet")
    found = placed.groupBy("doc", "longs", run).agg(
        F.min("place").alias("place"), F.min("row").alias("row"), F.max(F.when(F.col("own").isNull(), F.col("row"))).alias("long_row"),
        F.array_sort(F.collect_list(F.when(F.col("own").isNotNull(), F.struct("place", "own")))).alias("run"),
    )
    text = F.when(F.col("long_row").isNull(), F.array_join(F.transform("run", lambda p: p["own"]), between))
    sheets = materialize(found.select("doc", F.col("place").cast("long").alias("page"), "row", "long_row", text.alias("text")), "sheets")
    whole = pages.filter(size > short).select(F.col("row").alias("long_row"), F.col("text").alias("whole"))
    long_pages = sheets.filter("long_row is not null").drop("text").join(whole, "long_row").select("doc", "page", "row", F.col("whole").alias("text"))
    return sheets.filter("long_row is null").drop("long_row").unionByName(materialize(long_pages, "long_pages"))


def _begun(parts: Column, ahead: Column) -> Column:
    """How many of the last parts begin in the last ``ahead`` characters of all, and how many characters they have."""

    def step(done: Column, part: Column) -> Column:
        size = done["size"] + F.length(part)
        fits = done["open"] & (size <= F.length(ahead))
        return F.struct(
            F.when(fits, done["n"] + 1).otherwise(done["n"]).alias("n"), F.when(fits, size).otherwise(done["size"]).alias("size"), fits.alias("open")
        )

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("size"), F.lit(True).alias("open"))
    return F.aggregate(F.reverse(F.slice(parts, F.lit(2), F.size(parts))), start, step)


def _spill(tail: Column, ahead: Column, header: str) -> Column:
    """Characters after ``tail`` that belong to a header which begins in it."""

    def spill(parts: Column) -> Column:
        def after(begun: Column) -> Column:
            last = F.get(parts, F.size(parts) - 1 - begun["n"])
            inside = F.length(last) - (F.length(ahead) - begun["size"])
            size = F.length(F.regexp_extract(last, f"(?U)^(?:{header})", 0))
            return F.when(F.size(parts) - begun["n"] > 1, F.greatest(F.lit(0), size - inside)).otherwise(0)

        return bind(_begun(parts, ahead), after)

    return bind(marked_pieces(F.concat(tail, ahead), header), spill)


def _parts_of_page(text: Column, skip: Column, ahead: Column, header: str) -> Column:
    """The page up to its first header and from each of its headers on, the first ``skip`` characters being none's."""

    def parts(found: Column) -> Column:
        def cut(begun: Column) -> Column:
            kept = F.size(found) - begun["n"]
            last = F.get(found, kept - 1)
            own = F.left(last, F.length(last) - (F.length(ahead) - begun["size"]))
            lead = F.left(text, skip)
            every = F.concat(F.slice(found, F.lit(1), kept - 1), F.array(own))
            return F.concat(F.array(F.concat(lead, F.get(every, F.lit(0)))), F.slice(every, F.lit(2), F.size(every)))

        return bind(_begun(found, ahead), cut)

    return bind(marked_pieces(F.concat(F.substr(text, skip + 1), ahead), header), parts)


def extract_batch(
    df: DataFrame,
    fn: Callable[[str], str],
    prompt: str = "prompt",
    response: str = "response",
) -> DataFrame:
    """Rows with the caller's answer to their prompt; a failing call gives the error text.

    Marked non-deterministic, so that Spark never evaluates a costly call twice in a
    plan; the flows write the answers before they use them more than once.
    """
    failed = QUERY_ERROR

    def answer(text):
        try:
            return fn(text)
        except Exception:  # noqa: BLE001 - any failure of the caller's function
            return failed

    @F.pandas_udf("string")
    def answers(prompts: pd.Series) -> pd.Series:
        return prompts.map(answer)

    return df.withColumn(response, answers.asNondeterministic()(F.col(prompt)))


def parse_responses(df: DataFrame, abstract: str = "Abstract", response: str = "response") -> DataFrame:
    """Extractions from the responses that are one JSON object; `Genes` keeps its JSON shape.

    The response stays beside them, with whatever other fields it has.
    """
    parsed = keep_where(df, strict_object(response), lambda fields: fields.isNotNull(), "_fields")
    return parsed.select(
        F.col(abstract).alias("abstract"), "_fields.Disease", "_fields.Genes", "_fields.comment",
        F.col(response).alias("response"),
    )


def rejected_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """The responses that ``parse_responses`` leaves out, as they came."""
    return df.filter(strict_object(response).isNull())


def gene_list(genes: Column) -> Column:
    """Genes of a polymorphic field: a comma text is split, a list taken as it is, else one null."""
    shape = F.schema_of_variant(genes)
    text = F.try_variant_get(genes, "$", "string")
    split = F.transform(F.split(text, ","), lambda g: F.nullif(strip(g), F.lit("")))
    listed = F.transform(
        F.try_variant_get(genes, "$", "array<string>"), lambda g: F.when(g != "", strip(g))
    )
    none = F.array(F.lit(None).cast("string"))
    return (
        F.when((shape == "STRING") & (text != MISSING), split)
        .when(shape.startswith("ARRAY<"), listed)
        .otherwise(none)
    )


def explode_genes(
    df: DataFrame, abstract: str = "abstract", disease: str = "Disease", genes: str = "Genes"
) -> DataFrame:
    """One row per gene of an extraction; a null gene where there is none; no row for an empty list."""
    text = F.coalesce(abstract, F.lit(""))
    return df.select(
        abstract_number(text).alias("Abstract_Number"),
        text.alias("Abstract"),
        na_to_null(disease).alias("Disease"),
        F.explode(gene_list(F.col(genes))).alias("Genes"),
    )
