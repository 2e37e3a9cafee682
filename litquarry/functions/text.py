"""Column functions over free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litquarry.functions.binding import bind

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Session headers that open an abstract, missing-value text, prompt marker.
SESSION_HEADER = (
    r"\d{3,}\s+(Poster Session|Oral Abstract Session|Rapid Oral Abstract Session"
    r"|Clinical Science Symposium)"
)
MISSING = "n/a"
PROMPT_MARKER = "[[[abstract]]]"
NO_ABSTRACT = "No abstract available"

_MARK = "\uffff"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(_column(col), F.lit(WHITESPACE))


def is_blank(col: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(col) == "", F.lit(True))


def na_to_null(col: Column | str) -> Column:
    return F.nullif(_column(col), F.lit(MISSING))


def null_to_na(col: Column | str) -> Column:
    return F.coalesce(_column(col), F.lit(MISSING))


def clean_indication(col: Column | str) -> Column:
    """Text before the first comma, without parenthesised parts and special characters, lower case."""
    first = strip(F.split_part(_column(col).cast("string"), F.lit(","), F.lit(1)))
    plain = F.regexp_replace(first, r"\([^)]*\)", "")
    plain = F.regexp_replace(plain, r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]", "")
    return F.coalesce(strip(F.lower(plain)), F.lit(""))


def abstract_number(col: Column | str) -> Column:
    """Leading digits, or null."""
    return F.nullif(F.regexp_extract(_column(col), r"(?U)^(\d+)", 1), F.lit(""))


def marked_pieces(col: Column | str, header: str = SESSION_HEADER) -> Column:
    """Array of the text before the first header and of the pieces, as they stand, from one header to the next.

    Headers are marked and the text is split at the marks; a text that holds the mark itself,
    which is no character, is cut by the pattern alone.
    """
    text = _column(col)
    marked = F.split(F.regexp_replace(text, f"(?U)({header})", f"{_MARK}$1"), _MARK, -1)
    lead = F.regexp_extract(text, rf"(?Us)^(.*?)(?:(?:{header})|\z)", 1)
    found = F.regexp_extract_all(text, F.lit(rf"(?Us)((?:{header}).*?)(?=(?:{header})|\z)"), F.lit(1))
    return F.when(F.contains(text, F.lit(_MARK)), F.concat(F.array(lead), found)).otherwise(marked)


def header_pieces(col: Column | str, header: str = SESSION_HEADER) -> Column:
    """Array of stripped pieces, each from one header up to the next header or the end.

    Text before the first header belongs to no piece.
    """
    return bind(marked_pieces(col, header), lambda parts: F.transform(F.slice(parts, F.lit(2), F.size(parts)), strip))


def render_prompt(template: str, col: Column | str, marker: str = PROMPT_MARKER) -> Column:
    """The template with every marker replaced by the column's text, taken literally."""
    return F.replace(F.lit(template), F.lit(marker), _column(col))


def join_sections(sections: Column | str, default: str = NO_ABSTRACT) -> Column:
    """Abstract sections joined with a space; the default where there is no section list."""
    return F.coalesce(F.array_join(_column(sections), " ", ""), F.lit(default))
