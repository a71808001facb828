"""Strict JSON and first-present-key extraction on string columns.

Spark's JSON readers are lenient (single quotes, trailing garbage, raw newlines in
strings), Python's ``json.loads`` is not.  A line is accepted only when

* ``'[' || v || ']'`` parses to an array of exactly one element, and
* ``'{"k":' || v || '}'`` parses,

which together reject trailing garbage, several values, single quotes, raw control
characters, ``NaN``/``Infinity`` and duplicate keys. Python accepts the last two, so rejected
lines, and only they, are read again by ``reread``.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys tried, in order, by the lenient extractor.
TEXT_KEYS = ["text", "content", "prompt", "completion"]

# Python's str.strip() whitespace = Unicode White_Space plus \x1c-\x1f.
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"


def is_blank(v: Column) -> Column:
    """``line.strip() == ''`` with Python's notion of whitespace."""
    return ~F.coalesce(v.rlike(_NOT_SPACE), F.lit(False))


def strict_value(v: Column) -> Column:
    """The parsed VARIANT of ``v`` if ``v`` is exactly one strict JSON value, else NULL."""
    one = F.size(F.try_parse_json(F.concat(F.lit("["), v, F.lit("]"))).try_cast("array<variant>")) == 1
    wrapped = F.try_parse_json(F.concat(F.lit('{"k":'), v, F.lit("}")))
    return F.when(F.coalesce(one, F.lit(False)) & wrapped.isNotNull(),
                  F.variant_get(wrapped, "$.k", "variant"))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def has_key(value: Column, key: str) -> Column:
    """Key presence: a JSON null value counts as present (it is a VARIANT null, not SQL NULL)."""
    return F.variant_get(value, f"$.{key}", "variant").isNotNull()


def first_present_key(value: Column, keys: list[str] = TEXT_KEYS) -> Column:
    """The first key of ``keys`` present in the object (not ``coalesce`` of values)."""
    expr = None
    for k in keys:
        expr = F.when(has_key(value, k), F.lit(k)) if expr is None else expr.when(has_key(value, k), F.lit(k))
    return expr


def key_value(value: Column, key: Column, keys: list[str] = TEXT_KEYS) -> Column:
    """VARIANT value of the chosen key."""
    expr = None
    for k in keys:
        got = F.variant_get(value, f"$.{k}", "variant")
        expr = F.when(key == k, got) if expr is None else expr.when(key == k, got)
    return expr


def text_status(line: Column, value: Column, key: Column, picked: Column) -> Column:
    """Why a line does or does not yield a text sample (quarantine reasons)."""
    return (F.when(is_blank(line), F.lit("blank"))
            .when(value.isNull(), F.lit("invalid"))
            .when(~is_object(value), F.lit("not_object"))
            .when(key.isNull(), F.lit("no_key"))
            .when(F.is_variant_null(picked), F.lit("null_text"))
            .when(F.schema_of_variant(picked) != "STRING", F.lit("non_string"))
            .otherwise(F.lit("ok")))


def variant_string(v: Column) -> Column:
    return F.variant_get(v, "$", "string")


def _reread_line(line: str | None, keys: list[str]) -> tuple[str | None, str | None, str | None]:
    """(status, key, text) of a line that only Python's parser may accept."""
    if line is None:
        return None, None, None
    try:
        value = json.loads(line)
    except (ValueError, RecursionError):
        return "invalid", None, None
    if not isinstance(value, dict):
        return "not_object", None, None
    key = next((k for k in keys if k in value), None)
    if key is None:
        return "no_key", None, None
    if isinstance(value[key], str):
        return "ok", key, value[key]
    return "null_text" if value[key] is None else "non_string", key, None


def reread(line: Column, keys: list[str] = TEXT_KEYS) -> Column:
    """Struct (status, key, text) of a line by Python's parser; null for a null line.

    Declared non-deterministic, so that a filter on the result isn't pushed down with copies of the call and of its input.
    """

    @F.pandas_udf("struct<status: string, key: string, text: string>")
    def parse(lines: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_reread_line(v, keys) for v in lines], columns=["status", "key", "text"], dtype=object)

    return parse.asNondeterministic()(line)
