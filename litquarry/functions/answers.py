"""JSON answers: writing them byte for byte and reading them strictly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.functions.binding import bind

STRICT_JSON = {"allowSingleQuotes": "false"}

_AS_ASCII = {"writeNonAsciiCharacterAsCodePoint": "true"}


def json_text(col: Column | str) -> Column:
    """A JSON string literal in ASCII, other characters as \\uXXXX; null gives ``null``."""
    text = F.col(col) if isinstance(col, str) else col
    written = F.to_json(F.struct(text.alias("t")), _AS_ASCII)
    literal = bind(written, lambda j: F.substr(j, F.lit(len('{"t":') + 1), F.length(j) - len('{"t":}')))
    literal = F.replace(literal, F.lit("\x7f"), F.lit("\\u007F"))
    return F.when(text.isNull(), F.lit("null")).otherwise(literal)


def encode_answer(disease: Column | str, genes: Column | str) -> Column:
    """``{"Disease": ..., "Genes": ...}`` with spaced separators."""
    return F.concat(
        F.lit('{"Disease": '), json_text(disease), F.lit(', "Genes": '), json_text(genes), F.lit("}")
    )


def is_json(text: Column) -> Column:
    """True where a text is exactly one JSON value.

    One wrapping alone would let some trailing text through: the list form accepts
    a closing bracket after the value, the field form a closing brace.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT_JSON)
    field = F.from_json(F.concat(F.lit('{"r":'), text, F.lit("}")), "r string", STRICT_JSON)
    one = (F.size(listed) == 1) & (field["r"].isNotNull() | (btrim_json(text) == "null"))
    return F.coalesce(one, F.lit(False))


def btrim_json(text: Column) -> Column:
    """A text without the white space that JSON allows around a value."""
    return F.btrim(text, F.lit(" \t\n\r"))


def is_json_object(text: Column) -> Column:
    """True where a text is exactly one JSON object."""
    return F.coalesce(btrim_json(text).startswith("{"), F.lit(False)) & is_json(text)


def other_fields(text: Column, known: list[str]) -> Column:
    """The fields of a JSON object beside the known ones: name and JSON text of each; null for none.

    Values are the text as it stands; only strings, which the reader unescapes, are written anew.
    """
    plain = F.from_json(text, "map<string,string>", STRICT_JSON)
    typed = F.from_json(text, "map<string,variant>", STRICT_JSON)

    def written(types: Column):
        return lambda name, value: F.when(value.isNull(), F.lit("null")).when(
            F.schema_of_variant(F.try_element_at(types, name)) == "STRING", json_text(value)
        ).otherwise(value)

    rest = F.map_filter(plain, lambda name, _: ~name.isin(*known))
    return bind(rest, lambda found: F.when(F.size(found) > 0, bind(typed, lambda types: F.transform_values(found, written(types)))))


def _object(*parts: Column, rest: Column | None = None) -> Column:
    """A JSON object of the parts that are not null, and of the other fields."""
    fields = F.array_compact(F.array(*parts))
    if rest is not None:
        others = F.transform(F.map_entries(rest), lambda e: F.concat(json_text(e["key"]), F.lit(": "), e["value"]))
        fields = F.concat(fields, F.coalesce(others, F.array().cast("array<string>")))
    return F.concat(F.lit("{"), F.array_join(fields, ", "), F.lit("}"))


def _field(name: str, value: Column, written: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f'"{name}": '), written))


def _listed(values: Column, written) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, written), ", "), F.lit("]"))


def _function(call: Column) -> Column:
    return _object(*[_field(n, call[n], json_text(call[n])) for n in ("name", "arguments")])


def chat_line(df: DataFrame, messages: str = "messages") -> Column:
    """One JSON line per sample: its messages, functions and tools, and every other field it came with.

    Fields that are null are left out; functions and tools hold JSON texts and are written as they are.
    """
    message_type = df.schema[messages].dataType.elementType

    def call(c: Column) -> Column:
        has_rest = "rest" in message_type["tool_calls"].dataType.elementType.fieldNames()
        return _object(
            _field("id", c["id"], json_text(c["id"])), _field("function", c["function"], _function(c["function"])),
            rest=c["rest"] if has_rest else None,
        )

    def message(m: Column) -> Column:
        names = message_type.fieldNames()
        parts = [_field(n, m[n], json_text(m[n])) for n in ("role", "content", "text", "name", "tool_call_id") if n in names]
        if "function_call" in names:
            parts.append(_field("function_call", m["function_call"], _function(m["function_call"])))
        if "tool_calls" in names:
            parts.append(_field("tool_calls", m["tool_calls"], _listed(m["tool_calls"], call)))
        return _object(*parts, rest=m["rest"] if "rest" in names else None)

    parts = [_field("messages", F.col(messages), _listed(F.col(messages), message))]
    for name in ("functions", "tools"):
        if name in df.columns:
            parts.append(_field(name, F.col(name), _listed(F.col(name), lambda text: text)))
    return _object(*parts, rest=F.col("rest") if "rest" in df.columns else None)


# Fields of a parsed response.
RESPONSE_FIELDS = "Disease string, Genes variant, comment string"


def strict_object(col: Column | str) -> Column:
    """Fields of a response that is exactly one JSON object, else null; the last of repeated keys counts."""
    text = F.col(col) if isinstance(col, str) else col
    return F.when(is_json_object(text), F.from_json(text, RESPONSE_FIELDS, STRICT_JSON))
