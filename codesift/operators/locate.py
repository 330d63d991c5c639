"""Locating reported snippets in files: W5 line_windows, T3 similarity, A3 arg-max,
J7 finding x file, L1 locate_snippets, L3/A5 relocate_diff.

Semantics kept from the original tool: the file is split into lines (universal
newlines); every window of 1..min(5, n) consecutive lines is whitespace-collapsed and
scored with ``difflib.SequenceMatcher(None, snippet, window).ratio()`` (auto-junk on,
argument order kept); the best score wins, ties going to the smaller window, then the
earlier start; a match needs score >= 0.6.

Plan:
1. All files are cut into blocks of ``BLOCK_LINES`` lines, each with the lines that its last windows reach into, and written
   once by the tasks that read them.  Blocks meet findings on (repo, path, salt); a file has as many salts as it has blocks,
   at most ``BLOCK_SALTS``; only files with several salts are listed.  A meeting moves every text once.
2. *Exact windows.*  A snippet that occurs in its file as whole lines has its best window there: score 1, reached by equal
   texts only.  Such findings are settled by comparing strings; steps 3 to 5 see the other findings and their files.
3. *Prune.*  The blocks that meet other findings get a character histogram per line, summed up from line to line.  The difference
   of two entries is the histogram of a window, and the overlap of two histograms bounds the matches that the ratio can
   count, so every window's bound ``2*overlap/(la+lb)`` is known without its text.  Both are array arithmetic over Arrow batches.
4. The window with the highest bound of each finding is scored by difflib: the score to beat.
5. Only windows whose bound is above that score, or equal to it with a smaller window or earlier start, are built as text
   and scored; a partial aggregate takes the best.  Nothing is moved for it if no finding is left.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesift.functions.text import collapse_ws, line_range, split_lines
from codesift.plans import prompts as P
from codesift.session import spread, written

#: Windows of a block start in this many lines.
BLOCK_LINES = 256
#: Tasks over which the blocks of one file are spread at most.
BLOCK_SALTS = 64
#: Characters counted one by one (in lower case); of all others digits, the rest of ASCII and what is beyond it are counted.
COUNTED = string.ascii_lowercase + " "
DIGIT, ASCII, BEYOND, NONE = range(len(COUNTED), len(COUNTED) + 4)
#: Arrow batches of blocks and windows: a block can be long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: Places in a histogram: length, lines with text, then the counted characters.
N_CHARS, N_LINES, FIRST_COUNT = 0, 1, 2
SPACE = FIRST_COUNT + COUNTED.index(" ")
PLACES = FIRST_COUNT + NONE


def _kind(byte: int) -> int:
    """The place of a byte of UTF-8 among the counts; ``NONE`` for bytes that continue a character."""
    if byte >= 0x80:
        return NONE if byte < 0xC0 else BEYOND
    c = chr(byte).lower()
    return COUNTED.index(c) if c in COUNTED else DIGIT if c.isdigit() else ASCII


KIND = np.array([_kind(byte) for byte in range(256)])
#: Bytes of text counted at a time, and entries of blocks compared at a time.
CHUNK_BYTES, CHUNK_ENTRIES = 1 << 20, 1 << 13
#: Cells of two texts that ``ratio`` compares at once.
MATRIX_BITS = 1 << 22


def _run(x: str, i: int, y: str, j: int, most: int) -> int:
    """How many characters from ``x[i]`` and ``y[j]`` on are equal, ``most`` at most."""
    n = 0
    while n + 32 <= most and x[i + n:i + n + 32] == y[j + n:j + n + 32]:
        n += 32
    while n < most and x[i + n] == y[j + n]:
        n += 1
    return n


def ratio(x: str, y: str) -> float:
    """``SequenceMatcher(None, x, y).ratio()``.

    The table of equal characters of a pair of ranges is one number, a row of bits per character of ``x`` (none for those that
    difflib ignores as popular in ``y``); shifted by diagonals and intersected with itself, it leaves the starts of the longest
    runs, the lowest bit being the run that difflib takes.
    """
    if len(x) * len(y) > MATRIX_BITS:
        return SequenceMatcher(None, x, y).ratio()
    masks: dict[str, int] = {}
    for j, c in enumerate(y):
        masks[c] = masks.get(c, 0) | 1 << j
    if popular := len(y) >= 200:
        masks = {c: m for c, m in masks.items() if m.bit_count() <= len(y) // 100 + 1}
    same, open_ = 0, [(0, len(x), 0, len(y))]
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        width = (bhi - blo) // 8 + 1  # a bit is left over, so that no diagonal runs into the next one
        cut, none = (1 << (bhi - blo)) - 1, bytes(width)
        rows = {c: (m >> blo & cut).to_bytes(width, "little") for c, m in masks.items()}
        table = int.from_bytes(b"".join([rows.get(c, none) for c in x[alo:ahi]]), "little")
        i, j, k = alo, blo, 0
        if table:
            step, runs = 8 * width + 1, [table]  # runs[t]: where 2 ** t equal characters begin
            while longer := runs[-1] & runs[-1] >> (step << len(runs) - 1):
                runs.append(longer)
            left, k = runs.pop(), 1 << len(runs)
            while runs:
                if longer := left & runs.pop() >> step * k:
                    left, k = longer, k + (1 << len(runs))
            i, j = divmod((left & -left).bit_length() - 1, 8 * width)
            i, j = i + alo, j + blo
        if popular:
            while i > alo and j > blo and x[i - 1] == y[j - 1]:
                i, j, k = i - 1, j - 1, k + 1
            k += _run(x, i + k, y, j + k, min(ahi - i, bhi - j) - k)
        if k:
            same += k
            if alo < i and blo < j:
                open_.append((alo, i, blo, j))
            if i + k < ahi and j + k < bhi:
                open_.append((i + k, ahi, j + k, bhi))
    return 2.0 * same / (len(x) + len(y)) if x or y else 1.0


@F.pandas_udf(T.DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def similarity(snippet: Column, window: Column) -> Column:
    """``SequenceMatcher(None, snippet, window).ratio()`` (not symmetric)."""
    return _ratio_udf(snippet, window)


def char_counts(texts: pa.Array) -> np.ndarray:
    """A row per text: length, 1 if there is any text, and how often each of ``COUNTED`` (either case) and the kinds of other characters occur.

    Every character has one place, so overlaps of these counts are upper bounds of overlaps of the characters themselves.
    """
    texts = texts.cast(pa.large_string())
    out = np.zeros((len(texts), PLACES), "int32")
    if not len(texts):
        return out
    ends = np.frombuffer(texts.buffers()[1], "int64", len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")
    kinds = NONE + 1
    for p in range(ends[0], ends[-1], CHUNK_BYTES):
        q = min(p + CHUNK_BYTES, ends[-1])
        lo, hi = np.searchsorted(ends, p, "right") - 1, np.searchsorted(ends, q, "left")
        place = np.repeat(np.arange(hi - lo) * kinds, np.diff(np.clip(ends[lo:hi + 1], p, q)))
        out[lo:hi, FIRST_COUNT:] += np.bincount(place + KIND[data[p:q]], minlength=(hi - lo) * kinds).reshape(-1, kinds)[:, :-1].astype("int32")
    out[:, N_CHARS] = out[:, FIRST_COUNT:].sum(axis=1)
    out[:, N_LINES] = out[:, N_CHARS] > 0
    return out


@F.arrow_udf(T.BinaryType())
def _counts_udf(texts: pa.Array) -> pa.Array:
    return pa.array([row.tobytes() for row in char_counts(texts)], pa.binary())


def histogram(text: Column) -> Column:
    """``char_counts`` of a text, as the bytes of 32-bit numbers."""
    return _counts_udf(text)


def line_blocks(files: DataFrame, max_window: int) -> DataFrame:
    """``(repo_id, path, salt, first, starts, lines)``: blocks of collapsed lines, each followed by the
    ``max_window - 1`` lines that its last windows reach into."""
    # out of a generator the lines are a column, split once.  *_outer + null filter: a plain explode lets the optimizer
    # infer size(lines) > 0 and evaluate the split twice
    lines = files.select("repo_id", "path", F.explode_outer(F.array(split_lines(F.col("text")))).alias("lines"))
    firsts = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1, F.lit(BLOCK_LINES)))
    blocks = lines.withColumn("first", F.explode_outer(firsts)).filter(F.col("first").isNotNull()).select(
        "repo_id", "path", F.pmod(F.floor(F.col("first") / BLOCK_LINES), F.lit(BLOCK_SALTS)).cast("int").alias("salt"), "first",
        F.least(F.lit(BLOCK_LINES), F.size("lines") - F.col("first")).alias("starts"),
        F.slice("lines", F.col("first") + 1, F.lit(BLOCK_LINES + max_window - 1)).alias("lines"))
    return blocks.withColumn("lines", F.transform("lines", collapse_ws))


@F.arrow_udf(T.BinaryType())
def _sums_udf(lines: pa.Array) -> pa.Array:
    def table(counts: np.ndarray) -> bytes:
        sums = np.zeros((len(counts) + 1, PLACES), "int32")
        np.cumsum(counts, axis=0, out=sums[1:])
        return sums.astype("uint16").tobytes() + b"\2" if sums[-1, N_CHARS] < 1 << 16 else sums.tobytes() + b"\4"

    ends, texts, out = lines.offsets.to_numpy(), lines.flatten(), []
    for lo, hi in _chunks(np.diff(ends)):
        counts = char_counts(texts.slice(ends[lo] - ends[0], ends[hi] - ends[lo]))
        out += [table(counts[a - ends[lo]:b - ends[lo]]) for a, b in pairwise(ends[lo:hi + 1])]
    return pa.array(out, pa.binary())


def _sums_of(table: bytes) -> np.ndarray:
    """The entries of a block; the last byte is the width of its numbers."""
    return np.frombuffer(table, f"uint{8 * table[-1]}", (len(table) - 1) // table[-1]).reshape(-1, PLACES)


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that have about ``CHUNK_ENTRIES`` together, one row at least."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_ENTRIES, "right")))
        yield lo, hi
        lo = hi


def with_sums(blocks: DataFrame) -> DataFrame:
    """Blocks with ``sums``: a table whose entry i is the histogram of the first i lines, as bytes."""
    return blocks.withColumn("sums", _sums_udf("lines"))


def file_blocks(files: DataFrame, max_window: int) -> DataFrame:
    """``line_blocks`` with their ``sums``."""
    return with_sums(line_blocks(files, max_window))


def _bounded(sums: pa.Array, starts: pa.Array, counts: pa.Array, max_window: pa.Array, least: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, size ``w``, 0-based start ``at`` and bound of the windows of each row's block whose bound reaches the row's ``least``."""
    snips = np.frombuffer(b"".join(counts.to_pylist()), "int32").reshape(-1, PLACES)
    least, starts, tables = least.to_numpy(), starts.to_numpy(), sums.to_pylist()
    for lo, hi in _chunks(np.array([len(t) // (t[-1] * PLACES) for t in tables], "int64")):
        parts = [_sums_of(t) for t in tables[lo:hi]]
        sizes = np.array([len(x) for x in parts])
        table, first = np.concatenate(parts, dtype="int32"), np.cumsum(sizes) - sizes
        n_starts = np.minimum(starts[lo:hi], sizes - 1)
        rows = np.repeat(np.arange(hi - lo), n_starts)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
        for w in range(1, max_window[0].as_py() + 1):
            fits = places + w < sizes[rows]
            row, at = rows[fits], places[fits]
            low = first[row] + at
            joints = np.maximum(table[low + w, N_LINES] - table[low, N_LINES] - 1, 0)
            chars = table[low + w, N_CHARS] - table[low, N_CHARS] + joints
            n = snips[lo + row, N_CHARS]
            both, goal = chars.astype("int64") + n, least[lo + row]
            # the length bound first: two look-ups instead of a whole histogram
            near = (both == 0) | (2.0 * np.minimum(chars, n) >= goal * both)
            row, at, low, joints, chars, n, both, goal = (x[near] for x in (row, at, low, joints, chars, n, both, goal))
            window = table[low + w] - table[low]
            window[:, SPACE] += joints
            shared = np.minimum(window, snips[lo + row])[:, FIRST_COUNT:].sum(axis=1)
            # the ratio's own formula, so that a window that reaches its bound has exactly this score
            bound = np.where(both == 0, 1.0, 2.0 * np.minimum(shared, np.minimum(chars, n)) / np.maximum(both, 1))
            kept = bound >= goal
            yield lo + row[kept], np.full(kept.sum(), w), at[kept], bound[kept]


def _joined(found: Iterator[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    none = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))
    return [np.concatenate(x) for x in zip(none, *found)]


#: A window of a block and its bound.
PLACE = T.StructType([T.StructField("w", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("bound", T.DoubleType())])


def _places(w: np.ndarray, at: np.ndarray, bound: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    columns = pa.array(w, pa.int32()), pa.array(at, pa.int32()), pa.array(bound, pa.float64())
    return pa.StructArray.from_arrays(columns, ["w", "at", "bound"], mask=None if mask is None else pa.array(mask))


@F.arrow_udf(T.ArrayType(PLACE))
def _windows_udf(sums: pa.Array, starts: pa.Array, counts: pa.Array, max_window: pa.Array, least: pa.Array) -> pa.Array:
    """All windows of the block that reach ``least``."""
    row, w, at, bound = _joined(_bounded(sums, starts, counts, max_window, least))
    by = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[by], np.arange(len(sums) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _places(w[by], at[by], bound[by]))


@F.arrow_udf(PLACE)
def _likely_udf(sums: pa.Array, starts: pa.Array, counts: pa.Array, max_window: pa.Array, least: pa.Array) -> pa.Array:
    """The window of the block with the highest bound, the smaller and then the earlier of equal ones; null if none reaches ``least``."""
    row, w, at, bound = _joined(_bounded(sums, starts, counts, max_window, least))
    by = np.lexsort((at, w, -bound, row))
    top = by[np.unique(row[by], return_index=True)[1]]
    out = [np.zeros(len(sums), x.dtype) for x in (w, at, bound)]
    none = np.ones(len(sums), bool)
    none[row[top]] = False
    for x, y in zip(out, (w, at, bound)):
        x[row[top]] = y[top]
    return _places(*out, mask=none)


def window_bounds(met: DataFrame, max_window: int, least: float | Column) -> DataFrame:
    """``met`` (a block and a snippet ``snip`` with its ``snip_counts`` a row) -> W5: one row per window whose ratio can
    reach ``least``, with its size ``w``, its 0-based start ``at`` in the block and ``bound``, the most its ratio can be."""
    found = _windows_udf("sums", "starts", "snip_counts", F.lit(max_window), least if isinstance(least, Column) else F.lit(float(least)))
    return met.withColumn("_found", found).select(
        *[c for c in met.columns if c not in ("sums", "snip_counts", "starts", "salt")], F.inline("_found"))


@F.pandas_udf(T.DoubleType())
def _score_udf(snippet: pd.Series, window: pd.Series, goal: pd.Series) -> pd.Series:
    """The ratio, or null where it stays below the goal."""
    def score(x: str, y: str, least: float) -> float | None:
        if x == y:
            return 1.0
        if least > 0 and 2.0 * (Counter(x) & Counter(y)).total() < least * (len(x) + len(y)):
            return None
        return ratio(x, y)

    return pd.Series([score(*row) for row in zip(snippet, window, goal)], dtype="float64")


def window_text(at: Column, w: Column) -> Column:
    """The collapsed text of the ``w`` lines from ``at`` on of a block."""
    return F.array_join(F.filter(F.slice("lines", at + 1, w), lambda x: x != ""), " ")


def with_text(windows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``window``, the collapsed text of each window, from its block."""
    text = window_text(F.col("at"), F.col("w"))
    lines = blocks.select("repo_id", "path", "first", "lines")
    return windows.join(lines, ["repo_id", "path", "first"]).withColumn("window", text).drop("lines")


def _score(windows: DataFrame, goal: Column) -> DataFrame:
    """A3: the best-scored window of each finding that reaches its goal, as (finding_id, best), and the highest ``bound``
    that went in.  The caller deals the windows to tasks."""
    place = F.struct("score", (-F.col("w")).alias("w"), (-F.col("first") - F.col("at")).alias("s"))
    scored = windows.select("finding_id", "w", "first", "at", "bound", _score_udf("snip", "window", goal).alias("score"))
    return scored.filter(F.col("score") >= F.lit(0.0)).groupBy("finding_id").agg(F.max(place).alias("best"), F.max("bound").alias("bound"))


def several_salts(blocks: DataFrame) -> DataFrame:
    """``(repo_id, path, most)``: the files whose blocks have more than one salt, with the highest."""
    return blocks.groupBy("repo_id", "path").agg(F.max("salt").alias("most")).filter("most > 0")


def _salted(wanted: DataFrame, several: DataFrame) -> DataFrame:
    """Every finding once for each salt of its file."""
    salts = F.sequence(F.lit(0), F.coalesce("most", F.lit(0)))
    return wanted.join(several, ["repo_id", "path"], "left").withColumn("salt", F.explode(salts)).drop("most")


def _meet(wanted: DataFrame, blocks: DataFrame, several: DataFrame | None = None) -> DataFrame:
    """Every finding with every block of its file, spread over the file's own salts."""
    return blocks.join(_salted(wanted, several_salts(blocks) if several is None else several), ["repo_id", "path", "salt"])


def exact_windows(wanted: DataFrame, blocks: DataFrame, max_window: int, several: DataFrame | None = None) -> DataFrame:
    """The findings whose snippet is the text of a window, as (finding_id, best), with the smallest, then earliest such window.

    It begins with a line that the snippet begins with; with a blank line only if the snippet is blank (else the window
    without that line is smaller).
    """
    def begins(at: Column) -> Column:
        line = F.get("lines", at)
        return F.when(line == "", F.col("snip") == "").otherwise(F.col("snip").startswith(line))

    def equal(at: Column) -> Column:
        sizes = F.filter(F.sequence(F.lit(1), F.least(F.lit(max_window), F.size("lines") - at)),
                         lambda w: window_text(at, w) == F.col("snip"))
        return F.transform(sizes, lambda w: F.struct(F.lit(1.0).alias("score"), (-w).alias("w"), (-F.col("first") - at).alias("s")))

    starts = F.filter(F.sequence(F.lit(0), F.col("starts") - 1), begins)
    met = _meet(wanted, blocks, several).select("finding_id", F.array_max(F.flatten(F.transform(starts, equal))).alias("best"))
    return met.filter(F.col("best").isNotNull()).groupBy("finding_id").agg(F.max("best").alias("best"))


def most_likely_windows(wanted: DataFrame, blocks: DataFrame, threshold: float, max_window: int, several: DataFrame | None = None) -> DataFrame:
    """Of every finding the window with the highest bound, the smaller and then the earlier of equal ones, with its text."""
    likely = _likely_udf("sums", "starts", "snip_counts", F.lit(max_window), F.lit(float(threshold)))
    tops = _meet(wanted, blocks, several).withColumn("_top", likely).filter(F.col("_top").isNotNull()).select(
        "finding_id", F.struct("_top.bound", (-F.col("_top.w")).alias("_w"), (-F.col("first") - F.col("_top.at")).alias("_s"), "_top.w", "first",
                               "_top.at", window_text(F.col("_top.at"), F.col("_top.w")).alias("window"), "snip").alias("top"))
    return spread(tops, "finding_id").groupBy("finding_id").agg(F.max("top").alias("top")).select("finding_id", "top.*").drop("_w", "_s")


def _unsettled(first_best: DataFrame) -> DataFrame:
    """A finding whose most likely window reached its bound is settled: every other window has a smaller bound, is larger or
    begins later."""
    return first_best.filter(F.col("best.score") < F.col("bound")).drop("bound")


def remaining_windows(wanted: DataFrame, first_best: DataFrame, blocks: DataFrame, threshold: float, max_window: int,
                      several: DataFrame | None = None) -> DataFrame:
    """The windows that can still beat a finding's score so far (``goal``), by their bounds, with their text."""
    ahead = wanted.join(_unsettled(first_best), "finding_id").select(
        *wanted.columns, F.greatest("best.score", F.lit(float(threshold))).alias("goal"), F.col("best.score").alias("_score"),
        F.col("best.w").alias("_w"), F.col("best.s").alias("_s"))
    rows = window_bounds(_meet(ahead, blocks, several), max_window, F.col("goal"))
    start = F.col("first") + F.col("at")
    earlier = (F.col("w") < -F.col("_w")) | ((F.col("w") == -F.col("_w")) & (start < -F.col("_s")))
    better = rows.filter((F.col("bound") > F.col("_score")) | ((F.col("bound") == F.col("_score")) & earlier))
    better = better.withColumn("window", window_text(F.col("at"), F.col("w"))).drop("lines", "_score", "_w", "_s")
    return spread(better, "finding_id", "first", "at")


def _places_of(wanted: DataFrame, several: DataFrame) -> DataFrame:
    """``(repo_id, path, salt)`` of all blocks that meet a finding."""
    return _salted(wanted.select("repo_id", "path").distinct(), several).select("repo_id", "path", "salt")


def locate_snippets(findings: DataFrame, files: DataFrame, threshold: float = P.LOCATE_THRESHOLD,
                    max_window: int = P.LOCATE_MAX_WINDOW) -> DataFrame:
    """L1: ``findings(finding_id, repo_id, path, snippet)`` x ``files(repo_id, path, text)`` ->
    ``(finding_id, start, end, score, line)``; ``line`` is ``[]`` when nothing reaches the
    threshold or the file is unknown.  ``finding_id`` must be unique.
    """
    f = written(findings.select("finding_id", "repo_id", "path", collapse_ws(F.col("snippet")).alias("snip")), "snippets")
    asked = f.filter(F.col("snip").isNotNull())
    lines = written(line_blocks(files.select("repo_id", "path", "text"), max_window), "line-blocks")
    several = written(several_salts(lines), "salts")
    exact = written(exact_windows(asked, lines, max_window, several), "exact-windows")
    wanted = written(asked.join(exact, "finding_id", "left_anti").withColumn("snip_counts", histogram(F.col("snip"))), "inexact-snippets", BATCHES)

    def of(places: DataFrame) -> DataFrame:
        return lines.join(places, ["repo_id", "path", "salt"], "left_semi")

    likely = most_likely_windows(wanted, with_sums(of(_places_of(wanted, several))), threshold, max_window, several)
    first_best = written(_score(likely, F.lit(0.0)), "first-best", BATCHES)
    best = exact.unionByName(first_best.select("finding_id", "best"))
    left = wanted.join(_unsettled(first_best), "finding_id", "left_semi")
    # written, so that the size of the list is known: texts are not moved for a short one
    left = written(_places_of(left, several), "unsettled-blocks")
    if not left.isEmpty():
        # the few files that are left are counted again, which is less than keeping the histograms of all
        rest = remaining_windows(wanted, first_best, of(left).withColumn("sums", _sums_udf("lines")), threshold, max_window, several)
        best = best.unionByName(written(_score(rest, F.col("goal")).select("finding_id", "best"), "other-best", BATCHES))
    best = best.groupBy("finding_id").agg(F.max("best").alias("best")) \
        .filter(F.col("best.score") >= threshold) \
        .select("finding_id", "best.score", (-F.col("best.w")).alias("w"), (1 - F.col("best.s")).alias("start"))
    out = f.select("finding_id").join(best, "finding_id", "left").withColumn("end", F.col("start") + F.col("w") - 1)
    return out.select(
        "finding_id", "start", "end", "score",
        F.when(F.col("start").isNotNull(), line_range(F.col("start"), F.col("end")))
        .otherwise(F.array().cast("array<int>")).alias("line"),
    )


def relocate_diff(stored: DataFrame, files: DataFrame, threshold: float = P.LOCATE_THRESHOLD) -> dict[str, DataFrame]:
    """L3 + A5: recompute the lines of stored findings and report only differences.

    ``stored(repo_id, finding_id, file_path, code_snippet, line)``.  Findings without a snippet
    or path count only in the total.  Found and different -> changed; found and equal ->
    unchanged; not found -> not_found, plus a changed row with ``new_line = []`` when it had
    lines.  Returns ``changed`` rows and ``summary`` per repo.
    """
    usable = F.col("code_snippet").isNotNull() & F.col("file_path").isNotNull()
    s = stored.withColumn("_usable", usable)
    loc = locate_snippets(
        s.filter("_usable").select("finding_id", "repo_id", F.col("file_path").alias("path"),
                                   F.col("code_snippet").alias("snippet")),
        files, threshold,
    )
    j = s.join(loc.select("finding_id", F.col("line").alias("new_line")), "finding_id", "left")
    old = F.coalesce(F.col("line"), F.array().cast("array<int>"))
    found = F.size(F.coalesce(F.col("new_line"), F.array().cast("array<int>"))) > 0
    case = (
        F.when(~F.col("_usable"), F.lit("skipped"))
        .when(found & (F.col("new_line") != old), F.lit("changed"))
        .when(found, F.lit("unchanged"))
        .otherwise(F.lit("not_found"))
    )
    j = j.withColumn("case", case).withColumn("old_line", old)
    changed = j.filter((F.col("case") == "changed") | ((F.col("case") == "not_found") & (F.size(old) > 0))).select(
        "repo_id", "finding_id", "file_path", "code_snippet", "old_line",
        F.when(F.col("case") == "changed", F.col("new_line")).otherwise(F.array().cast("array<int>")).alias("new_line"),
    )
    summary = j.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("total_vulnerabilities"),
        F.count_if((F.col("case") == "changed") | ((F.col("case") == "not_found") & (F.size(old) > 0))).alias("changed_count"),
        F.count_if(F.col("case") == "unchanged").alias("unchanged_count"),
        F.count_if(F.col("case") == "not_found").alias("not_found_count"),
    )
    return {"changed": changed, "summary": summary, "cases": j.select("repo_id", "finding_id", "case", "old_line", "new_line")}
