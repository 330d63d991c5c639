"""Text functions (Column -> Column).

F6 sha1, F7 loc, F8 token_estimate, F9 extract_imports, F10 decode_ignore,
F11 head_chars, T1 collapse_ws, T2 split_lines, T12 line_range, py_strip.

All native except ``decode_ignore``, which sends only rows holding invalid
UTF-8 through a small Arrow UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's str.isspace() set, as a Java character class: ASCII \s, \x1c-\x1f, U+0085 and all
# Unicode separators (Zs, Zl, Zp).  U+200B is not whitespace in either.
WS_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"

# Characters per token of the rough estimate, import pattern.
TOKEN_CHARS_PER_TOKEN = 4
IMPORT_PATTERN = r"^(?:import|from)\s+([\w./\-@]+)"

# Java form of IMPORT_PATTERN: (?U) makes \w and \s Unicode-aware like Python's str patterns.
_IMPORT_JAVA = "(?U)" + IMPORT_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def universal_newlines(text: Column | str) -> Column:
    """'\\r\\n' and lone '\\r' become '\\n' (Python text-mode reading)."""
    return F.regexp_replace(_c(text), r"\r\n?", "\n")


def sha1_hex(content: Column | str) -> Column:
    """SHA-1 of the raw bytes (strings hash their UTF-8 encoding)."""
    return F.sha1(_c(content))


def loc(text: Column | str) -> Column:
    """number of '\\n' plus one, after newline translation; '' -> 1."""
    t = universal_newlines(text)
    return (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def token_estimate(text: Column | str) -> Column:
    """F8: int(chars / 4) + 1 over the decoded, newline-translated text."""
    t = universal_newlines(text)
    return (F.floor(F.length(t) / TOKEN_CHARS_PER_TOKEN) + 1).cast("bigint")


def head_chars(text: Column | str, n: int | None = None) -> Column:
    """first n code points (after newline translation); the whole text without ``n``."""
    whole = universal_newlines(text)
    return whole if n is None else F.substring(whole, 1, n)


def py_strip(s: Column | str) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    return F.regexp_replace(_c(s), "^" + WS_CLASS + "+|" + WS_CLASS + r"+\z", "")


def collapse_ws(s: Column | str) -> Column:
    """``" ".join(s.split())``."""
    return F.trim(F.regexp_replace(_c(s), WS_CLASS + "+", " "))


def split_lines(text: Column | str) -> Column:
    """Lines of a text read with universal newlines; no trailing empty line; '' -> []."""
    # texts without "\r" need no pattern
    t = _c(text)
    parts = F.split(F.when(F.contains(t, F.lit("\r")), universal_newlines(t)).otherwise(t), "\n", -1)
    return F.when(
        F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)
    ).otherwise(parts)


def line_range(start: Column | str, end: Column | str) -> Column:
    """[start .. end] as an int list."""
    return F.sequence(_c(start).cast("int"), _c(end).cast("int"))


def extract_imports(text: Column | str, max_lines: int | None = None) -> Column:
    """module token of 'import x' / 'from x' lines among the first ``max_lines`` lines (default:
    all), duplicates kept."""
    lines = split_lines(text) if max_lines is None else F.slice(split_lines(text), 1, max_lines)
    found = F.transform(lines, lambda ln: F.regexp_extract(py_strip(ln), _IMPORT_JAVA, 1))
    return F.filter(found, lambda m: m != "")


@F.pandas_udf(T.StringType())
def _decode_ignore_udf(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def decode_ignore(content: Column | str) -> Column:
    """bytes -> text, dropping invalid UTF-8 bytes.

    Valid rows are cast natively; only invalid rows cross into Python (the UDF
    receives null for every valid row, so Arrow ships almost nothing).
    """
    b = _c(content)
    as_text = b.cast("string")
    valid = F.is_valid_utf8(as_text)
    return F.when(valid, as_text).otherwise(_decode_ignore_udf(F.when(~valid, b)))
