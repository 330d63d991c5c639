"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of m characters may occur in a document with up to k edits, about one in ``CHARS_PER_EDIT``.  It
is cut into k + 1 pieces of at least ``GRAM`` characters; an occurrence with at most k edits leaves
one piece untouched.  Rolling hashes of all ``GRAM``-character windows of a document are looked up
in the table of the pieces' beginnings and a hit is compared with its piece.  The hits of an item that point to neighbouring
places are merged into one interval, and Myers' bit-parallel pass runs once over each interval, so a repetitive text costs its
length, not its number of hits.  Occurrences of an item whose ends are at most twice its budget apart count once, as the
nearest (then first) of them.

Case and kind of white space are ignored (letters are folded one to one, so positions stay).

Documents are scanned where they lie, in one ``mapInArrow`` pass per block of items; no document is shuffled.
Items reach the tasks in blocks of about ``BLOCK_CHARS`` characters: the total size is measured first, and a larger benchmark
is hashed into more blocks, each collected and broadcast by itself.

Defined cases: null or empty documents and items match nothing; an item too short for one edit must occur
exactly; equal items are found under each of their ids; repeated rows give repeated results; empty
tables give an empty result; extra columns are ignored by ``find_leaks`` and passed through by ``drop_leaks``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS_PER_EDIT = 20
GRAM = 16
#: Bits of the first look-up table; it only sorts out windows that begin no piece.
FILTER_BITS = 20
BLOCK_CHARS = 4_000_000
SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint, distance int"
_BLANKS = "\t\n\x0b\x0c\r\xa0"


def fold(text: str) -> str:
    """Lower case and plain blanks, character for character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for blank in _BLANKS:
        low = low.replace(blank, " ")
    return low


def distances(pattern: str, text: str) -> Iterator[int]:
    """For every end in ``text`` the distance of ``pattern`` to the nearest substring that ends there.

    Myers' algorithm: bit i of ``up``/``down`` says that the distance grows/falls by one from row i
    to row i + 1 of the current column; a match may begin at any column.
    """
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    up, down, score = mask, 0, m
    for c in text:
        eq = places.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & mask
        right_up = (down | ~(diagonal | up)) & mask
        right_down = up & diagonal
        if right_up & high:
            score += 1
        elif right_down & high:
            score -= 1
        right_up = (right_up << 1) & mask
        right_down = (right_down << 1) & mask
        up = (right_down | ~(diagonal | right_up)) & mask
        down = right_up & diagonal
        yield score


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` nearest to ``pattern``; the first such end."""
    best, end = len(pattern), 0
    for j, score in enumerate(distances(pattern, text), 1):
        if score < best:
            best, end = score, j
    return best, end


def nearest_ends(found: Iterator[tuple[int, int]], apart: int) -> Iterator[tuple[int, int]]:
    """Of (end, distance) in order of ends: the smallest distance, then the first end, of those at most ``apart`` behind
    the first."""
    first, best = None, None
    for end, distance in found:
        if first is None or end > first + apart:
            if best is not None:
                yield best
            first, best = end, (end, distance)
        elif distance < best[1]:
            best = (end, distance)
    if best is not None:
        yield best


def merged(intervals: list[tuple[int, int]], gap: int) -> list[tuple[int, int]]:
    """Intervals at most ``gap`` apart as one."""
    out: list[list[int]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` characters beginning at each position, by doubling the window's length."""
    h = codes.astype(np.uint64)
    base, width = _BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), 2 * width
    return h * np.uint64(_BASE)


def edit_budget(length: int) -> int:
    """Edits allowed in an item: one per ``CHARS_PER_EDIT``, and few enough that no piece is shorter than ``GRAM``."""
    return max(0, min(length // CHARS_PER_EDIT, length // GRAM - 1))


class Items:
    """The pieces of a block of benchmark items, by the hash of their first ``GRAM`` characters."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.items: list[tuple[int, str, int]] = []
        self.pieces: dict[int, dict[str, list[tuple[int, int]]]] = {}  # gram hash -> piece -> (item, offset)
        short: dict[str, list[int]] = {}  # items shorter than a gram
        for item_id, raw in items:
            text = fold(raw or "").strip()
            if not text:
                continue
            n, k = len(self.items), edit_budget(len(text))
            self.items.append((item_id, text, k))
            if len(text) < GRAM:
                short.setdefault(text, []).append(n)
                continue
            hashes = _gram_hashes(_codes(text))
            for p in range(k + 1):
                a, b = p * len(text) // (k + 1), (p + 1) * len(text) // (k + 1)
                self.pieces.setdefault(int(hashes[a]), {}).setdefault(text[a:b], []).append((n, a))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[[h >> 64 - FILTER_BITS for h in self.pieces]] = True
        self.short = ahocorasick.Automaton()
        for text, uses in short.items():
            self.short.add_word(text, (len(text), uses))
        if short:
            self.short.make_automaton()

    def _intervals(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per item the places at which it would begin without edits, neighbouring ones as intervals."""
        uses: dict[str, list[tuple[int, int]]] = {}
        runs: dict[str, list[list[int]]] = {}
        if len(text) >= GRAM and self.pieces:
            hashes = _gram_hashes(_codes(text))
            for at in np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)]).tolist():
                for piece, places in self.pieces.get(int(hashes[at]), {}).items():
                    if text.startswith(piece, at):
                        uses[piece] = places
                        run = runs.setdefault(piece, [])
                        if run and at <= run[-1][1] + GRAM:
                            run[-1][1] = at
                        else:
                            run.append([at, at])
        begins: dict[int, list[tuple[int, int]]] = {}
        for piece, places in uses.items():
            for n, offset in places:
                begins.setdefault(n, []).extend((a - offset, b - offset) for a, b in runs[piece])
        if len(self.short):
            for last, (length, items) in self.short.iter(text):
                for n in items:
                    begins.setdefault(n, []).append((last + 1 - length, last + 1 - length))
        return {n: merged(x, 2 * self.items[n][2]) for n, x in begins.items()}

    def _ends(self, text: str, n: int, intervals: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """(end, distance) within the budget of item n, interval by interval."""
        _, pattern, k = self.items[n]
        for first, last in intervals:
            low = max(0, first - k)
            window = text[low:last + len(pattern) + k]
            yield from ((low + i, d) for i, d in enumerate(distances(pattern, window), 1) if d <= k)

    def leaks(self, raw: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of every occurrence within the items' error budgets."""
        text, out = fold(raw or ""), []
        for n, intervals in self._intervals(text).items():
            item_id, pattern, k = self.items[n]
            for end, distance in nearest_ends(iter(sorted(set(self._ends(text, n, intervals)))), 2 * k):
                # the occurrence from its end: the shortest of the nearest substrings
                back = text[max(0, end - len(pattern) - k):end][::-1]
                out.append((item_id, end - best_match(pattern[::-1], back)[1], end, distance))
        return out

    def any_leak(self, raw: str | None) -> bool:
        """Whether any item occurs; the first occurrence ends the search."""
        text = fold(raw or "")
        return any(True for n, intervals in self._intervals(text).items() for _ in self._ends(text, n, intervals))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str | None]]]:
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_CHARS))
    for b in range(n):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield [(r[0], r[1]) for r in block.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per occurrence of a benchmark item in a document (see ``SCHEMA``)."""
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "item_id", "start", "end", "distance"]

    def search(block: list[tuple[int, str | None]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value)
            for batch in batches:
                rows = [(doc_id.as_py(), *leak) for doc_id, text in zip(batch.column(0), batch.column(1))
                        for leak in items.leaks(text.as_py())]
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if n == "distance" else pa.int64()) for c, n in zip(columns, names)], names=names)

        return narrow.mapInArrow(run, SCHEMA)

    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        out = search(block) if out is None else out.unionByName(search(block))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item occurs, with all their columns."""
    at, kept = docs.columns.index(text_col), docs
    for block in _blocks(benchmark, item_col, item_text_col):
        kept = kept.mapInArrow(_without(docs.sparkSession.sparkContext.broadcast(block), at), docs.schema)
    return kept


def _without(shared, at: int):
    """Passes the rows on whose text in column ``at`` holds no item of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([not items.any_leak(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return run
