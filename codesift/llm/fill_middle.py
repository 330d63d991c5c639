"""Fill-in-the-middle rewriting by memoized content-defined chunks.

A text is cut into three parts at two places that a hash of its id chooses, counted in units (code points), and
the parts are put in another order behind markers.  Only the number of units, the byte places of the two cuts and
whether a marker occurs in the text are needed, and all three are put together from chunks:

1. *Chunks.*  A polynomial rolling hash of the last ``WINDOW`` bytes ends a chunk where its top bits are zero, so the
   cuts depend on content only and passages that documents share fall into the same chunks.  No chunk is
   shorter than ``MIN_CHUNK`` (but the last) or longer than ``MAX_CHUNK`` bytes.  Long texts are hashed in slices.
2. *Boundary summaries.*  A chunk's summary is what the text around it has to know: how many units begin in it, whether
   a marker lies inside, and its last bytes and first bytes, in which a marker or a unit may cross to the next chunk.
   Summaries are cached by the chunk's bytes, so a hit is verified by content, never by a hash alone.
   The cache has two generations of at most ``CACHE_BYTES`` each: a chunk still in use when a generation
   is full moves to the next one.
3. *Cuts.*  Running sums of the counts find the chunk in which a unit begins; only that chunk is counted through.

One narrow pass without a shuffle; a lost task is repeated from its input rows alone, as a result never depends on
what the cache holds.

Defined cases: a null text is empty; empty texts and texts that hold a marker stay plain; a null id counts as
an empty string; repeated rows are each rewritten, rows with one id at equal fractions; very long texts are processed
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesift.llm.suffix_dedup import gram_names

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: Bytes of a marker that may lie on either side of a chunk's end.
EDGE = max(map(len, MARKERS)) - 1
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Hundredths of the texts with another form: ``RATE`` are rewritten, ``SPM_RATE`` of these suffix first.
RATE, SPM_RATE = 90, 20

WINDOW = 32
#: One position in 2^CUT_BITS ends a chunk.
CUT_BITS = 9
MIN_CHUNK, MAX_CHUNK = 64, 4096
SLICE = 1 << 20
CACHE_BYTES = 16 << 20
#: Bytes of output gathered before they leave the worker.
FLUSH_BYTES = 8 << 20
_CONTINUED = bytes(range(0x80, 0xC0))
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _candidates(raw: bytes) -> Iterator[int]:
    """Ends of chunks by the rolling hash, in order."""
    codes = np.frombuffer(raw, np.uint8)
    for low in range(0, max(0, len(codes) - WINDOW + 1), SLICE):
        names = gram_names(codes[low:low + SLICE + WINDOW - 1], WINDOW)
        yield from (np.flatnonzero(names >> np.uint64(64 - CUT_BITS) == 0) + (low + WINDOW)).tolist()


def chunk_ends(raw: bytes) -> list[int]:
    """The end of every chunk of a text."""
    ends, begin = [], 0
    for end in _candidates(raw):
        while end - begin > MAX_CHUNK:
            begin += MAX_CHUNK
            ends.append(begin)
        if end - begin >= MIN_CHUNK:
            ends.append(end)
            begin = end
    while len(raw) - begin > MAX_CHUNK:
        begin += MAX_CHUNK
        ends.append(begin)
    if begin < len(raw):
        ends.append(len(raw))
    return ends


class Summary(NamedTuple):
    """What a run of bytes tells its neighbours."""

    units: int
    marked: bool
    head: bytes
    tail: bytes


def summarize(chunk: bytes) -> Summary:
    units = len(chunk) if chunk.isascii() else len(chunk.translate(None, _CONTINUED))
    return Summary(units, any(m in chunk for m in MARKERS), chunk[:EDGE], chunk[-EDGE:])


def combine(a: Summary, b: Summary) -> Summary:
    """The summary of two neighbouring runs of bytes from theirs."""
    across = a.tail + b.head
    return Summary(a.units + b.units, a.marked or b.marked or any(m in across for m in MARKERS),
                   (a.head + b.head)[:EDGE] if len(a.head) < EDGE else a.head, (a.tail + b.tail)[-EDGE:])


class SummaryCache:
    """Summaries by content, in two generations of bounded size."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit = limit
        self._new: dict[bytes, Summary] = {}
        self._old: dict[bytes, Summary] = {}
        self._size = 0
        self.computed = 0

    def get(self, chunk: bytes) -> Summary:
        found = self._new.get(chunk)
        if found is None:
            found = self._old.get(chunk)
            if found is None:
                found = summarize(chunk)
                self.computed += 1
            self._size += len(chunk)
            if self._size > self.limit:
                self._old, self._new, self._size = self._new, {}, len(chunk)
            self._new[chunk] = found
        return found


class Text:
    """A text as chunks with their summaries."""

    def __init__(self, raw: bytes, cache: SummaryCache):
        self.raw = raw
        ends = chunk_ends(raw)
        self.begins = [0, *ends[:-1]]
        self.ends = ends
        parts = [cache.get(raw[a:b]) for a, b in zip(self.begins, ends)]
        whole = Summary(0, False, b"", b"")
        for part in parts:
            whole = combine(whole, part)
        self.n, self.marked = whole.units, whole.marked
        self.before = [0, *accumulate(p.units for p in parts)]

    def place(self, unit: int) -> int:
        """The byte at which a unit begins; the end of the text for the unit after the last."""
        if unit >= self.n:
            return len(self.raw)
        k = bisect_right(self.before, unit) - 1
        low, high = self.begins[k], self.ends[k]
        if high - low == self.before[k + 1] - self.before[k]:
            return low + unit - self.before[k]
        chunk = np.frombuffer(self.raw, np.uint8, high - low, low)
        return low + int(np.flatnonzero(chunk & 0xC0 != 0x80)[unit - self.before[k]])


def draws(doc_id: int | None, seed: int = 1) -> tuple[int, int, int, int]:
    """Four numbers from the digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def rewrite(doc_id: int | None, raw: bytes, cache: SummaryCache, seed: int = 1) -> tuple:
    """(n, form, prefix_chars, middle_chars, output bytes) of one text."""
    text, (h1, h2, h3, h4) = Text(raw, cache), draws(doc_id, seed)
    if not text.n or text.marked or h3 % 100 >= RATE:
        return text.n, PLAIN, None, None, raw
    first, second = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    a, b = text.place(first), text.place(second)
    prefix, middle, suffix = MARKERS[0] + raw[:a], MARKERS[2] + raw[a:b], MARKERS[1] + raw[b:]
    spm = h4 % 100 < SPM_RATE
    return text.n, SPM if spm else PSM, first, second - first, (suffix + prefix if spm else prefix + suffix) + middle


def _rows(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    cache, rows, held = SummaryCache(), [], 0
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def flush() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        # the parts are whole code points of a valid text
        output = pa.array(columns[5], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns[:5], kinds)), output], names=names)

    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for doc_id, text in zip(batch.column(0), texts):
            doc_id = doc_id.as_py()
            rows.append((doc_id, *rewrite(doc_id, text.as_py() or b"", cache, seed)))
            held += len(rows[-1][-1])
            if held > FLUSH_BYTES:
                yield flush()
                rows, held = [], 0
    if rows:
        yield flush()


def fill_in_middle(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` (see ``SCHEMA``): its units, form, part sizes and the rewritten text."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lambda batches: _rows(batches, seed), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that was rewritten, from the output and its form.

    A rewritten text holds no marker, so the first place of each marker is its own.
    """
    middle = F.instr(output, MIDDLE)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        at = F.instr(output, second)
        return F.substring(output, F.lit(len(first) + 1), at - len(first) - 1), \
            F.substring(output, at + len(second), middle - at - len(second))

    rest = F.substring(output, middle + len(MIDDLE), F.length(output))
    prefix, suffix = parts(PREFIX, SUFFIX)
    suffix_2, prefix_2 = parts(SUFFIX, PREFIX)
    return F.when(form == PSM, F.concat(prefix, rest, suffix)).when(form == SPM, F.concat(prefix_2, rest, suffix_2)).otherwise(output)
