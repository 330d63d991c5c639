"""Strict JSON handling of model answers.

Python's ``json.loads`` rejects trailing garbage, which ``from_json`` and
``try_parse_json`` accept.  The answer is wrapped into an object next to a key that is the
answer's own hash, and exactly these two keys must come back: a text cannot contain its
own hash, so none can close the wrapper early.  The few answers that
Spark rejects but Python accepts (NaN/Infinity tokens, duplicate object keys)
are re-parsed by a small Arrow UDF that only ever sees those failed rows.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.functions.text import WS_CLASS, py_strip


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- fences

def strip_fence_a(answer: Column | str) -> Column:
    """F14 (selection answers): strip, then if it starts with a fence remove a leading
    '```json' plus whitespace, or a bare leading '```', and a trailing '```'; strip again."""
    s = py_strip(answer)
    cleaned = py_strip(F.regexp_replace(s, "^```json" + WS_CLASS + "*|^```|```\\z", ""))
    return F.when(s.startswith("```"), cleaned).otherwise(s)


def strip_fence_b(answer: Column | str) -> Column:
    """F15 (grouping answers): strip; if it starts with a fence drop the first line, then cut
    at the last '```' and strip."""
    s = py_strip(answer)
    nl = F.instr(s, "\n")
    body = F.when(nl > 0, F.substring(s, nl + 1, 1 << 30)).otherwise(s)
    # 0-based start of the last '```' = len - (first hit in the reversed text) - 2
    last = F.length(body) - F.instr(F.reverse(body), "```") - 2
    cut = F.when(F.instr(body, "```") > 0, py_strip(F.substring(body, 1, last))).otherwise(body)
    return F.when(s.startswith("```"), cut).otherwise(s)


# --------------------------------------------------------------------------- parsing

def _py_reparse(text):
    if text is None:
        return None
    try:
        obj = json.loads(text, parse_constant=lambda _tok: 0.0)
    except (ValueError, RecursionError):
        return None

    def clean(o):
        if isinstance(o, float) and not math.isfinite(o):
            return 0.0
        if isinstance(o, list):
            return [clean(x) for x in o]
        if isinstance(o, dict):
            return {k: clean(v) for k, v in o.items()}
        return o

    return json.dumps(clean(obj))


@F.pandas_udf(T.StringType())
def _reparse_udf(texts: pd.Series) -> pd.Series:
    return texts.map(_py_reparse)


def _native_strict(text: Column) -> Column:
    seal = F.sha1(text)
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"'), seal, F.lit('":1}')))
    keys = F.map_keys(F.try_variant_get(wrapped, "$", "map<string, variant>"))
    sealed = (F.size(keys) == 2) & F.array_contains(keys, "v") & F.array_contains(keys, seal)
    return F.when(sealed, F.variant_get(wrapped, "$.v", "variant"))


def parse_json_strict(text: Column | str, python_fallback: bool = True) -> Column:
    """T4: VARIANT of ``json.loads(text)``, or null where Python would raise.

    Non-finite numbers (accepted by Python) come back as 0.0 so that type tests
    still see a number; duplicate keys keep the last value, as in Python.
    """
    t = _c(text)
    native = _native_strict(t)
    if not python_fallback:
        return native
    retry = _reparse_udf(F.when(native.isNull() & t.isNotNull(), t))
    return F.coalesce(native, _native_strict(retry))


def settled(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns computed once per row, where they stand.

    The optimizer copies an expression into every later expression and filter that uses it; what leaves a generator is a
    column like any other.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*[F.col(f"`{c}`") for c in names]))))


def with_json(df: DataFrame, text: Column, name: str = "_v") -> DataFrame:
    """``df`` with ``name``, the value of ``parse_json_strict(text)``, parsed once per row however often it is used."""
    first = settled(df.withColumn("_told", text), "_told")
    first = settled(first.withColumn("_native", _native_strict(F.col("_told"))), "_native")
    # only rows that the native parser rejects carry a text to Python
    again = first.withColumn("_retry", _reparse_udf(F.when(F.col("_native").isNull(), F.col("_told"))))
    value = F.coalesce(F.col("_native"), _native_strict(F.col("_retry")))
    return settled(again.withColumn(name, value).drop("_told", "_native", "_retry"), name)


def json_type(v: Column | str) -> Column:
    """'STRING', 'BIGINT', 'ARRAY<...>', 'OBJECT<...>', 'VOID' (JSON null) or null (no value)."""
    return F.schema_of_variant(_c(v))


def is_object(v: Column | str) -> Column:
    return F.coalesce(json_type(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column | str) -> Column:
    return F.coalesce(json_type(v).startswith("ARRAY"), F.lit(False))


def is_string(v: Column | str) -> Column:
    return F.coalesce(json_type(v) == "STRING", F.lit(False))


def as_array(v: Column | str) -> Column:
    """array<variant> when v is a JSON list, else null."""
    return F.try_variant_get(_c(v), "$", "array<variant>")


def is_string_array(v: Column | str) -> Column:
    """T5: a JSON list whose every element is a string ([] counts)."""
    arr = as_array(v)
    return F.coalesce(F.forall(arr, lambda e: F.coalesce(F.schema_of_variant(e) == "STRING", F.lit(False))),
                      F.lit(False))


def string_items(v: Column | str) -> Column:
    """The string elements of a JSON list, in order; null when not a list."""
    return F.transform(
        F.filter(as_array(v), lambda e: F.coalesce(F.schema_of_variant(e) == "STRING", F.lit(False))),
        lambda e: F.variant_get(e, "$", "string"),
    )


def py_str(e: Column) -> Column:
    """Python ``str()`` of a JSON scalar: strings as is, booleans 'True'/'False', null 'None'."""
    kind = F.schema_of_variant(e)
    return (
        F.when(kind == "STRING", F.variant_get(e, "$", "string"))
        .when(kind == "BOOLEAN", F.when(F.variant_get(e, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
        .when(kind == "VOID", F.lit("None"))
        .otherwise(F.to_json(e))
    )


def as_strings(v: Column | str) -> Column:
    """``[str(i) for i in items]`` for a JSON list (nested values render as JSON)."""
    return F.transform(as_array(v), py_str)


def has_key(v: Column | str, key: str) -> Column:
    """Key presence in a JSON object (a JSON null value still counts as present)."""
    return F.coalesce(is_object(v) & F.try_variant_get(_c(v), f"$.{key}", "variant").isNotNull(), F.lit(False))


def get_string(v: Column | str, key: str) -> Column:
    """Field as string only when it is a JSON string, else null."""
    sub = F.try_variant_get(_c(v), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(sub) == "STRING", F.variant_get(sub, "$", "string"))


def get_field(v: Column | str, key: str) -> Column:
    return F.try_variant_get(_c(v), f"$.{key}", "variant")


def params_json(params: Column | str) -> Column:
    """Params object as JSON without null entries (0 and false stay)."""
    return F.to_json(_c(params))
