"""Row identity: SHA-256 over key-sorted JSON text in plain ASCII.

The text has the layout a Python ``json`` dump with sorted keys and ASCII escapes gives, so stored
row hashes stay comparable across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.text import strip

# The two-character JSON escapes, applied in this order.
SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
)


# Characters with a short escape or below space, and all that ASCII output must escape.
_SHORT_OR_CONTROL = r'["\\\x00-\x1f]'
_NOT_PLAIN = r"[^\x20-\x7e]"


def _short_escapes(text: Column) -> Column:
    for char, escape in SHORT_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(escape))
    return text


def _code_unit_escapes(text: Column) -> Column:
    """Replace each distinct character outside plain ASCII by its UTF-16 escapes."""

    def escape(found: Column) -> Column:
        return F.regexp_replace(F.lower(F.hex(F.encode(found, "UTF-16BE"))), "(.{4})", r"\\u$1")

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({_NOT_PLAIN})"), F.lit(1)))
    return F.aggregate(found, text, lambda done, char: F.replace(done, char, escape(char)))


def json_strings(values: Column) -> Column:
    """ASCII JSON string literals of a text array; NULL items stay NULL.

    Working on an array keeps each step's input a plain variable, so no expression is repeated.
    """
    short = F.transform(values, lambda v: F.when(v.rlike(_SHORT_OR_CONTROL), _short_escapes(v)).otherwise(v))
    plain = F.transform(short, lambda v: F.when(v.rlike(_NOT_PLAIN), _code_unit_escapes(v)).otherwise(v))
    return F.transform(plain, lambda v: F.concat(F.lit('"'), v, F.lit('"')))


def json_object(keys: list[str], rendered: Column, skip_null: bool = False) -> Column:
    """A JSON object of sorted ``keys`` and an array of their rendered values.

    A NULL value is written as ``null``, or left out with ``skip_null``.
    """
    labels = F.array(*[F.lit(f'"{k}": ') for k in keys])

    def pair(label: Column, value: Column) -> Column:
        return F.concat(label, value if skip_null else F.coalesce(value, F.lit("null")))

    return F.concat(F.lit("{"), F.array_join(F.zip_with(labels, rendered, pair), ", "), F.lit("}"))


def _json_string(value: Column) -> Column:
    """``json_strings`` of one text. Plain ASCII, by far the most, needs no array and stays inside generated code."""
    escaped = value
    for char, escape in SHORT_ESCAPES[:2]:
        escaped = F.replace(escaped, F.lit(char), F.lit(escape))
    quoted = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(value.rlike(_NOT_PLAIN), json_strings(F.array(value))[0]).otherwise(quoted)


def json_text_object(fields: dict[str, Column], skip_null: bool = False) -> Column:
    """A JSON object of text fields with sorted keys."""
    keys = sorted(fields)
    if skip_null or not keys:
        return json_object(keys, json_strings(F.array(*[fields[k] for k in keys])), skip_null)
    pairs = [(F.lit(f'"{k}": '), F.coalesce(_json_string(fields[k]), F.lit("null"))) for k in keys]
    return F.concat(F.lit("{"), *[part for pair in pairs for part in (F.lit(", "), *pair)][1:], F.lit("}"))


def json_array(rendered: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(rendered, ", "), F.lit("]"))


def row_hash(columns: list[str], position: str | None = None) -> Column:
    """SHA-256 of a string row: values trimmed, NULL as ``""``.

    With ``position`` the row number is part of the identity, as in the review ingest: equal rows at
    two positions differ. Without it equal content hashes equally.
    """
    fields = {name: strip(F.col(f"`{name}`")) for name in columns}
    if position is not None:
        fields[position] = F.col(position).cast("string")
    return F.sha2(json_text_object(fields), 256)
