"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each text once and reports the anchors: at-signs, plus signs, digits,
scheme separators, identifier cues and credential cues.  At an anchor a deterministic local parser expands to the
boundaries of the item and validates it; text without anchors costs one automaton step per character.

Kinds, in the order in which equal starts are listed: email, ip, card, phone (the base kinds), then url,
account and secret (the value that a credential cue such as ``token`` or ``password`` names).  Base kinds are leftmost and non-overlapping within their kind; a candidate that fails its
check (part over 255, digit count, Luhn) is consumed and dropped.

Work is one ``mapInArrow`` pass without a shuffle: memory is bounded by one Arrow batch, every row is
independent, and a lost task repeats its own rows only.

Defined cases: a null or empty text has no spans; positions are code points, ends exclusive; the same text
repeated gives the same spans; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "url", "account", "secret"]
SCHEMA = "doc_id bigint, spans array<struct<start: bigint, kind_no: int, end: bigint, kind: string>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL_TAIL = re.compile(r"[^\s<>\"'`]+")
_ACCOUNT = re.compile(r"(?:[ \t]*(?:number|no\.?|nr\.?|id|#))?[ \t]*[:#=]?[ \t]*([A-Za-z]{0,4}[0-9][A-Za-z0-9]*(?:[ -][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)", re.I)
SCHEMES = ["http", "https", "ftp", "ftps", "sftp", "ssh", "file"]
CUES = ["account", "acct", "iban", "ssn", "passport", "routing"]
CREDENTIAL_CUES = ["token", "password", "passwd", "pwd", "secret", "api_key", "api-key", "api key", "apikey", "access_key", "access key",
                   "private_key", "private key", "bearer"]
#: From a credential cue to its value: the rest of the name, then a separator (a blank is enough behind ``bearer``), then a value in
#: quotes or of key characters.
_NAMED = re.compile(r"""([A-Za-z0-9_-]{0,32})["']?[ \t]{0,8}([:=]>?=?)?[ \t]{0,8}""")
_VALUE = re.compile(r"""(["'])(?P<quoted>[^\s"']+)\1|(?P<plain>[A-Za-z0-9+/_.~=-]+)""")
#: A secret has at least so many characters in quotes or without, among them a letter and a digit.
QUOTED_CHARS, PLAIN_CHARS = 8, 12
#: An account identifier has at least this many digits and at most this many characters.
ACCOUNT_DIGITS, ACCOUNT_CHARS = 6, 42


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, ("cue", len(form)))
    for cue in CREDENTIAL_CUES:
        for form in (cue, cue.capitalize(), cue.upper(), cue.title()):
            found.add_word(form, ("credential", len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    tail = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, tail.end()) if tail else None


def _ip_ok(found: str) -> bool:
    return all(int(part[-4:]) <= 255 and not part[:-4].strip("0") for part in found.split("."))


def _url(text: str, sep: int, free: int) -> tuple[int, int] | None:
    start = sep
    while start > free and sep - start < 6 and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    if text[start:sep].lower() not in SCHEMES:
        return None
    tail = _URL_TAIL.match(text, sep + 3)
    if not tail:
        return None
    end = tail.end()
    while end > sep + 3 and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return (start, end) if end > sep + 3 else None


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    found = _ACCOUNT.match(text, end)
    if not found or not ACCOUNT_DIGITS <= sum(c.isdigit() for c in found[1]) or len(found[1]) > ACCOUNT_CHARS:
        return None
    return found.span(1)


def _secret(text: str, cue: str, end: int) -> tuple[tuple[int, int], bool] | None:
    """The value that a credential cue before ``end`` names, and whether it looks like one."""
    named = _NAMED.match(text, end)
    # the value is only scanned behind a separator, so a run of cues is not scanned once for each of them
    found = _VALUE.match(text, named.end()) if named[2] or (cue == "bearer" and not named[1] and named.end() > end) else None
    if not found:
        return None
    kind = "quoted" if found["quoted"] else "plain"
    value = found[kind].rstrip(".=") if kind == "plain" else found[kind]
    valid = len(value) >= (QUOTED_CHARS if kind == "quoted" else PLAIN_CHARS) and any("0" <= c <= "9" for c in value) and any(c.isalpha() for c in value)
    return (found.start(kind), found.start(kind) + len(value)), valid


def find_spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of one text, ordered."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    free = [0] * len(KINDS)  # where the next item of each kind may begin

    def keep(kind: int, span: tuple[int, int] | None, valid: bool = True) -> None:
        if span:
            free[kind] = span[1]
            if valid:
                out.append((span[0], kind, span[1]))

    for last, (anchor, length) in automaton.iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= free[2]:
                m = _CARD.match(text, at)
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    keep(2, m.span(), 14 <= len(digits) <= 19 and _luhn(digits))
                else:
                    free[2] = at + 1
            if at >= free[1] and not (at > free[1] and "0" <= text[at - 1] <= "9"):
                m = _IP.match(text, at)
                if m:
                    keep(1, m.span(), _ip_ok(m[0]))
        elif anchor == "at":
            keep(0, _email(text, at, free[0]))
        elif anchor == "plus":
            m = _PHONE.match(text, at) if at >= free[3] else None
            if m:
                keep(3, m.span(), 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15)
        elif anchor == "scheme":
            if at >= free[4]:
                keep(4, _url(text, at, free[4]))
        elif anchor == "credential":
            found = _secret(text, text[at:last + 1].lower(), last + 1) if at >= free[6] else None
            if found:
                keep(6, *found)
        elif at >= free[5]:
            keep(5, _account(text, at, last + 1))
    out.sort()
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    item = pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64()), ("kind", pa.string())])
    for batch in batches:
        spans = [[(s, k, e, KINDS[k]) for s, k, e in find_spans(t.as_py(), automaton)] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([[dict(zip(("start", "kind_no", "end", "kind"), x)) for x in row] for row in spans],
                                       pa.list_(item))], names=["doc_id", "spans"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) per document; spans are ordered by start, then kind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, SCHEMA)
