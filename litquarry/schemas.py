"""Schemas of the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# What a match of a file without a section column reads as; a null section is one of a file that has it.
NO_SECTION = "(no section column)"

_IF_ABSENT = {"EXISTS_DEFAULT": f"'{NO_SECTION}'", "CURRENT_DEFAULT": f"'{NO_SECTION}'"}

MATCHES = T.StructType(
    _strings("pmid", "text", "keywordId", "type")
    + [
        T.StructField("organisms", T.ArrayType(T.StringType())),
        T.StructField("section", T.StringType(), True, _IF_ABSENT),
    ]
)

DISEASES = T.StructType(
    _strings("id", "name") + [T.StructField("therapeuticAreas", T.ArrayType(T.StringType()))]
)

GENE_SYMBOLS = T.StructType(_strings("ENSG", "HUGO"))

SYNTHETIC = T.StructType(_strings("abstract", "disease", "genes"))

# AbstractText is read as plain strings so that inline tags stay inside the text.
PUBMED_ARTICLE = T.StructType([
    T.StructField("MedlineCitation", T.StructType([
        T.StructField("PMID", T.StructType(_strings("_VALUE", "_Version"))),
        T.StructField("Article", T.StructType([
            T.StructField("ArticleTitle", T.StringType()),
            T.StructField("Abstract", T.StructType([
                T.StructField("AbstractText", T.ArrayType(T.StringType())),
            ])),
        ])),
    ])),
])

TOOL_FUNCTION = T.StructType(_strings("name", "arguments"))

TOOL_CALL = T.StructType([T.StructField("id", T.StringType()), T.StructField("function", TOOL_FUNCTION)])

MESSAGE = T.StructType(
    _strings("role", "content", "text", "name", "tool_call_id")
    + [
        T.StructField("function_call", TOOL_FUNCTION),
        T.StructField("tool_calls", T.ArrayType(TOOL_CALL)),
    ]
)

# Fields beside the declared ones, by name, as JSON texts.
REST = T.StructField("rest", T.MapType(T.StringType(), T.StringType()))

FULL_CALL = T.StructType(TOOL_CALL.fields + [REST])

FULL_MESSAGE = T.StructType([
    T.StructField(f.name, T.ArrayType(FULL_CALL)) if f.name == "tool_calls" else f for f in MESSAGE.fields
] + [REST])

# `functions` and `tools` hold each element's JSON text, so no field of it is lost.
CHAT_SAMPLE = T.StructType([
    T.StructField("messages", T.ArrayType(MESSAGE)),
    T.StructField("functions", T.ArrayType(T.StringType())),
    T.StructField("tools", T.ArrayType(T.StringType())),
])

EXTRACTIONS = T.StructType(
    _strings("abstract", "Disease")
    + [T.StructField("Genes", T.VariantType())]
    + _strings("comment")
)

TUMOR_TYPES = T.StructType(_strings("name", "code", "mainType"))
