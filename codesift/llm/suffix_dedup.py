"""Substring deduplication: removes every byte that lies in a ``WINDOW``-byte string which also starts in
a document with a smaller id.

A suffix array over all bytes (difference cover, names, merge) writes 16 bytes or more per byte of
text in every round; the README has the figures.  Only suffixes whose first ``WINDOW`` bytes recur can
change the result, so the order of suffixes is replaced by names (64-bit hashes of prefixes), and the sample of
positions that is named first is chosen by content instead of by a difference cover:

1. *Sample.*  The name of a window is the smallest name among its ``GRAM``-byte strings, so equal windows have
   equal names, and neighbouring windows mostly share one (about one name per 16 bytes).  Names that occur in two
   documents are found by one shuffle of (name, id).
2. *Merge.*  The bytes of each run of neighbouring windows with one shared name (its context) are sent to
   one task per name; there the full names of all windows are sorted, and neighbours with equal
   names show which windows also start in a smaller document.
   A name whose contexts have more than ``MOST`` bytes (the edge of a passage that many documents hold, where each context
   reaches into the document's own text, or a repetitive text, which is one long context) is left out there.  Its windows get
   their full names in their own document's task, equal windows of a document as one row, and travel by these names in the
   same shuffle; sorted by full name and id, the first row of a name is its smallest document.
3. *Remove.*  The covered byte ranges return to their documents.

Rows of one batch with equal names or contexts are combined before a shuffle (a name common to many
documents leaves each batch once), sorted inputs are read as streams, long texts are named in slices, and each step is
written under the shared checkpoint folder, so memory is bounded by a batch, by ``CHUNK`` and ``MOST`` bytes of contexts and by
some bytes per byte of a single text.  Names above the bound are a table that is joined, never collected.

Defined cases: a null text is empty, and nothing is removed from it; a null id neither loses bytes nor removes any; rows with equal ids
do not remove each other's bytes; an empty table gives an empty result; extra columns are ignored.
Positions are bytes of the UTF-8 text, so a removed run may begin or end inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.staging import staged

WINDOW = 50
GRAM = 20
SPAN = WINDOW - GRAM + 1
_BASE = 0x9E3779B97F4A7C15
#: Bytes of contexts gathered before their windows are sorted.
CHUNK = 2 << 20
#: Bytes of contexts that one name may have there.
MOST = 8 << 20
#: Windows sorted at a time.
STRIPE = 2 << 20
#: Windows of a text that are named at a time.
SLICE = 1 << 20
#: Names above the bound that are broadcast, 8 bytes each; more of them meet the others in a shuffle.
MOST_SENT = 1_000_000
#: Rows over which the names above the bound are kept.
SPREAD = 1024

NAMES = "name bigint, doc_id bigint, kind int"
CONTEXTS = "name bigint, row_id bigint, doc_id bigint, places binary, context binary"
RANGES = "row_id bigint, ranges binary"


def gram_names(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit names of the n bytes beginning at each position; the name of a length comes from the
    names of its powers of two."""
    power, width, base = codes.astype(np.uint64), 1, _BASE
    name, done = None, 0
    while True:
        if n & width:
            if name is None:
                name, done = power, width
            else:
                k = len(codes) - done - width + 1
                name = name[:k] * np.uint64(base) + power[done:done + k]
                done += width
        if done == n:
            break
        power = power[:-width] * np.uint64(base) + power[width:]
        base, width = base * base % (1 << 64), 2 * width
    name = name * np.uint64(_BASE)
    return name ^ (name >> np.uint64(29))


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """Minimum or maximum of every n consecutive values."""
    out, span = values, 1
    while 2 * span <= n:
        out, span = pick(out[:-span], out[span:]), 2 * span
    rest = n - span
    return pick(out[:-rest], out[rest:]) if rest else out


def window_names(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, name) of every run of windows with one name, for a text of at least
    ``WINDOW`` bytes."""
    lowest = _sliding(gram_names(codes, GRAM), SPAN, np.minimum)
    first = np.flatnonzero(np.r_[True, lowest[1:] != lowest[:-1]])
    return first, np.r_[first[1:] - 1, len(lowest) - 1], lowest[first]


def window_runs(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``window_names`` of a text of any length, slice by slice; a run may be cut between slices, which changes no window's
    name."""
    for low in range(0, len(codes) - WINDOW + 1, SLICE):
        first, last, name = window_names(codes[low:low + SLICE + WINDOW - 1])
        yield first + low, last + low, name


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of binary values."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    return offsets - offsets[0], np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]


def _binary(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """A column of binary values from their sizes and their bytes, end to end."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _batch(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, doc_id, kind) for the sampled names of each batch of (doc_id, text).

    The last two bits of kind are 0 for a name seen in one document of the batch.  A name of several documents of the
    batch is known to be shared: its smallest id stands for it (1), the other rows (2) need no comparison.  The
    rest of kind counts the bytes of the contexts that the row stands for.
    """
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        names, docs, counts = [], [], []
        for doc_id, text in zip(ids, texts):
            codes = _codes(text.as_py())
            if len(codes) >= WINDOW:
                runs = [(n, last - first + WINDOW) for first, last, n in window_runs(codes)]
                found, size = (np.concatenate(x) for x in zip(*runs))
                order = np.argsort(found, kind="stable")
                found = found[order]
                starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
                names.append(found[starts])
                counts.append(np.add.reduceat(size[order], starts))
                docs.append(np.full(len(starts), doc_id, np.int64))
        if not names:
            continue
        name, doc, count = np.concatenate(names), np.concatenate(docs), np.concatenate(counts)
        order = np.lexsort((doc, name))
        name, doc, count = name[order], doc[order], count[order]
        total = np.add.reduceat(count, np.flatnonzero(np.r_[True, name[1:] != name[:-1]]))
        fresh = np.r_[True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])]
        name, doc = name[fresh], doc[fresh]
        first = np.r_[True, name[1:] != name[:-1]]
        alone = first & np.r_[first[1:], True]
        kind = np.where(alone, 0, np.where(first, 1, 2)).astype(np.int32)
        kind[first] += (np.minimum(total, 1 << 28) * 4).astype(np.int32)
        yield _batch(["name", "doc_id", "kind"], [pa.array(name.view(np.int64)), pa.array(doc), pa.array(kind)])


def _shared_names(batches: Iterator[pa.RecordBatch], limit: int = MOST) -> Iterator[pa.RecordBatch]:
    """The rows of names that occur in two documents, from a stream sorted by name; a name with more than
    ``limit`` bytes of contexts also gets a row without an id.

    Between batches only the last name's evidence is kept: its id, or that it is shared, and its bytes so far.
    """
    held = None  # (name, doc_id, known to be shared, row still to be given out, bytes of contexts)
    for batch in batches:
        name, doc, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        count, kind, own = (kind >> 2).astype(np.int64), kind & 3, np.ones(len(name), bool)
        if held is not None:
            name, doc, count = np.r_[held[0], name], np.r_[held[1], doc], np.r_[held[4], count]
            kind, own = np.r_[np.int32(held[2]), kind], np.r_[held[3], own]
        if not len(name):
            continue
        starts = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        shared = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)) | (np.maximum.reduceat(kind, starts) > 0)
        sizes = np.diff(np.r_[starts, len(name)])
        out = np.repeat(shared, sizes) & own
        total = np.add.reduceat(count, starts)
        before = 0 if held is None or held[0] != name[0] else held[4]
        hot = shared & (total > limit)
        hot[0] &= before <= limit or not held[2]  # once for each name
        if hot.any():
            yield _batch(["doc_id", "name"], [pa.nulls(int(hot.sum()), pa.int64()), pa.array(name[starts[hot]])])
        held = (name[-1], doc[-1], int(shared[-1]), not shared[-1], total[-1])
        if out.any():
            yield _batch(["doc_id", "name"], [pa.array(doc[out]), pa.array(name[out])])


def _window_ranges(codes: np.ndarray, hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, low, high): the full names of the windows with ``hot`` names and the byte ranges they cover; places of
    equal windows that touch are one range."""
    for first, last, name in window_runs(codes):
        keep = np.isin(name.view(np.int64), hot)
        if keep.any():
            low = int(first[0])
            names = gram_names(codes[low:int(last[-1]) + WINDOW], WINDOW)
            n = last[keep] - first[keep] + 1
            place = np.repeat(first[keep] - np.cumsum(n) + n, n) + np.arange(n.sum())
            window = names[place - low]
            order = np.argsort(window, kind="stable")  # places of one window stay in order
            window, place = window[order], place[order]
            starts = np.flatnonzero(np.r_[True, (window[1:] != window[:-1]) | (place[1:] > place[:-1] + WINDOW)])
            yield window[starts], place[starts], place[np.r_[starts[1:] - 1, len(place) - 1]] + WINDOW


def _hot_windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of ``_context_rows`` for the windows with hot names."""
    row_ids, doc_ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
    parts = []
    for row_id, doc_id, text, names in zip(row_ids, doc_ids, batch.column(2), batch.column(4)):
        if len(names):
            for window, low, high in _window_ranges(_codes(text.as_py()), names.values.to_numpy(zero_copy_only=False)):
                parts.append((window, np.full(len(window), doc_id), np.full(len(window), row_id), low, high))
    if not parts:
        return
    window, doc, row, low, high = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((row, doc, window))
    window, doc, row, low, high = (x[order] for x in (window, doc, row, low, high))
    fresh = np.r_[True, window[1:] != window[:-1]]
    starts = np.flatnonzero(fresh | np.r_[True, row[1:] != row[:-1]])
    least = doc[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    later = (doc > least)[starts]
    ranges = _binary(8 * np.diff(np.r_[starts, len(row)]), np.stack([low, high], axis=-1).astype(np.int32))
    name = np.where(later, row[starts], window[starts].view(np.int64))
    yield _batch(["name", "row_id", "doc_id", "places", "context"], [
        pa.array(name), pa.array(row[starts]), pa.array(doc[starts]), ranges,
        pc.if_else(pa.array(later), pa.scalar(b""), pa.scalar(None, pa.binary()))])


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct context of each batch of (row_id, doc_id, text, shared names, hot names), and one per distinct
    window with a hot name, which has a null context and goes by the window's full name.

    The smallest document of the batch with that context or window carries it on, with all its places there.  In the
    later documents it is covered; their ranges make rows with an empty context.
    """
    columns = ["name", "row_id", "doc_id", "places", "context"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        row_ids, doc_ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        owner: dict[bytes, int] = {}
        rows: list[list] = []
        for i in np.lexsort((row_ids, doc_ids)).tolist():
            codes, row_id, doc_id = _codes(batch.column(2)[i].as_py()), int(row_ids[i]), int(doc_ids[i])
            wanted = batch.column(3)[i].values.to_numpy(zero_copy_only=False)
            raw, whole = codes.tobytes(), []
            for first, last, name in window_runs(codes) if len(wanted) else ():
                name = name.view(np.int64)
                keep = np.isin(name, wanted)
                for low, high, n in zip(first[keep].tolist(), (last[keep] + WINDOW).tolist(), name[keep].tolist()):
                    context = raw[low:high]
                    at = owner.get(context)
                    if at is not None and rows[at][2] < doc_id:
                        whole += (low, high)
                    elif at is not None and rows[at][1] == row_id:
                        rows[at][3].append(low)
                    else:
                        owner.setdefault(context, len(rows))
                        rows.append([n, row_id, doc_id, [low], context])
            if whole:
                rows.append([row_id, row_id, doc_id, whole, b""])
        if rows:
            for r in rows:
                r[3] = np.array(r[3], np.int32).tobytes()
            yield _batch(columns, [pa.array(c, k) for c, k in zip(zip(*rows), kinds)])
        yield from _hot_windows(batch)


def _covered(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Ranges covered by repeated windows, from all the contexts of some names."""
    known = pc.equal(pc.binary_length(rows.column(4)), 0)
    whole = rows.filter(pc.invert(known))
    if len(whole) < len(rows):
        yield _batch(["row_id", "ranges"], [rows.column(i).filter(known) for i in (1, 3)])
    if not len(whole):
        return
    offsets, codes = _flat(whole.column(4))
    begins, n = offsets[:-1], np.diff(offsets) - WINDOW + 1
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
    place = np.arange(ends[-1], dtype=np.int32) - np.repeat(ends - n, n).astype(np.int32)
    name = gram_names(codes, WINDOW)[np.repeat(begins, n) + place]
    doc = whole.column(2).to_numpy(zero_copy_only=False)
    stripes, found = -(-len(name) // STRIPE), []
    for k in range(stripes):  # equal windows are in one stripe
        order = np.flatnonzero(name % np.uint64(stripes) == k) if stripes > 1 else np.arange(len(name))
        if not len(order):
            continue
        order = order[np.argsort(name[order])]
        starts = np.flatnonzero(np.r_[True, np.diff(name[order].view(np.int64)) != 0])
        docs = doc[owner[order]]
        found.append(order[docs > np.repeat(np.minimum.reduceat(docs, starts), np.diff(np.r_[starts, len(order)]))])
    hit = np.sort(np.concatenate(found))
    if len(hit):
        # runs of neighbouring windows of one context, at each place of the context
        run = np.flatnonzero(np.r_[True, (owner[hit[1:]] != owner[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)])
        last = np.r_[run[1:] - 1, len(hit) - 1]
        run_owner, low, high = owner[hit[run]], place[hit[run]], place[hit[last]] + WINDOW
        offsets, places = _flat(whole.column(3))
        times = (np.diff(offsets) // 4)[run_owner]
        at = np.repeat(offsets[run_owner] // 4 - np.cumsum(times) + times, times) + np.arange(times.sum())
        at = places.view(np.int32)[at]
        pairs = np.stack([at + np.repeat(low, times), at + np.repeat(high, times)], axis=-1).astype(np.int32)
        yield _batch(["row_id", "ranges"], [whole.column(1).take(pa.array(run_owner)), _binary(8 * times, pairs)])


def _by_bytes(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of contexts."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(4)), 0).to_numpy().astype(np.int64))
    cuts = np.flatnonzero(np.diff(total // limit, prepend=0)).tolist()
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)


def _size(rows: pa.RecordBatch) -> int:
    return (pc.sum(pc.binary_length(rows.column(4))).as_py() or 0) + 64 * rows.num_rows


def _covered_rows(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The covered ranges from a stream of ``_context_rows`` sorted by name and id: contexts some whole names at a time,
    windows with hot names as they come."""
    held, size, last, least = [], 0, None, None
    for batch in batches:
        alone = pc.is_null(batch.column(4))
        hot = batch.filter(alone)
        if len(hot):
            name, doc = (hot.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            starts = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            first = doc[starts]
            if name[0] == last:
                first[0] = least
            later = pa.array(doc > np.repeat(first, np.diff(np.r_[starts, len(doc)])))
            last, least = name[-1], first[-1]
            yield _batch(["row_id", "ranges"], [hot.column(i).filter(later) for i in (1, 3)])
            batch = batch.filter(pc.invert(alone))
        for part in _by_bytes(batch, limit):
            held.append(part)
            size += _size(part)
            if size < limit:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            name = rows.column(0).to_numpy(zero_copy_only=False)
            end = int(np.searchsorted(name, name[-1]))
            if end:
                yield from _covered(rows.slice(0, end))
            held = [rows.slice(end)]
            size = _size(held[0])
    if held:
        yield from _covered(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, ranges in zip(*(batch.column(i) for i in range(3))):
            codes = _codes(text.as_py())
            spans = merged([np.frombuffer(x, np.int32).reshape(-1, 2) for x in (ranges.as_py() or [])])
            keep = np.ones(len(codes), bool)
            for a, b in spans:
                keep[a:b] = False
            kept = codes[keep].tobytes()
            rows.append((doc_id.as_py(), len(codes), len(codes) - len(kept), len(spans), kept,
                         hashlib.sha256(kept).hexdigest()))
        if rows:
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            yield _batch(names, [pa.array(c, k) for c, k in zip(zip(*rows), kinds)])


def merged(ranges: list[np.ndarray]) -> list[tuple[int, int]]:
    """Disjoint, non-touching ranges that cover the same positions."""
    if not ranges:
        return []
    pairs = np.concatenate(ranges)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    cut = np.flatnonzero(np.r_[True, pairs[1:, 0] > reach[:-1]])
    return list(zip(pairs[cut, 0].tolist(), reach[np.r_[cut[1:] - 1, len(pairs) - 1]].tolist()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) per row of ``docs``; ``kept`` has the remaining bytes.

    Names with more than ``limit`` bytes of contexts are compared by full window names; the result is the same."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = rows.withColumn("row_id", F.xxhash64("doc_id", "text"))
    known = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))

    names = known.mapInArrow(_name_rows, NAMES)
    # a row that needs no comparison goes anywhere, so that a common name does not meet in one task
    spread = F.when(F.col("kind").bitwiseAND(3) == 2, F.xxhash64("doc_id")).otherwise(F.col("name"))
    names = names.repartition(spread).sortWithinPartitions("name").mapInArrow(
        partial(_shared_names, limit=limit), "doc_id bigint, name bigint")
    spot = F.when(F.col("doc_id").isNull(), F.pmod(F.col("name"), F.lit(SPREAD)))
    shared = staged(names.groupBy("doc_id", spot.alias("spot")).agg(F.collect_set("name").alias("names")), "shared-names")

    hot = shared.filter(F.col("doc_id").isNull()).select(F.explode("names").alias("name"))
    usual = shared.filter(F.col("doc_id").isNotNull()).select("doc_id", "names")
    none = F.array().cast("array<bigint>")
    n_hot = hot.count()
    if n_hot:
        # only the rows of hot names are grouped again
        hot = F.broadcast(hot) if n_hot <= MOST_SENT else hot
        hot_names = usual.select("doc_id", F.explode("names").alias("name")).join(hot, "name") \
            .groupBy("doc_id").agg(F.collect_set("name").alias("hot_names"))
        usual = usual.join(hot_names, "doc_id", "left")
    else:
        usual = usual.withColumn("hot_names", none)
    carriers = keyed.filter(F.octet_length("text") >= WINDOW).join(usual, "doc_id").select(
        "row_id", "doc_id", "text", F.array_except("names", F.coalesce("hot_names", none)).alias("names"),
        F.coalesce("hot_names", none).alias("hot_names"))
    contexts = carriers.mapInArrow(_context_rows, CONTEXTS)
    spread = F.when(F.octet_length("context") == 0, F.xxhash64("row_id")).otherwise(F.col("name"))
    covered = contexts.repartition(spread).sortWithinPartitions("name", "doc_id").mapInArrow(_covered_rows, RANGES)
    ranges = staged(covered.groupBy("row_id").agg(F.collect_list("ranges").alias("ranges")), "covered-ranges")

    return keyed.join(ranges, "row_id", "left").select("doc_id", "text", "ranges").mapInArrow(
        _finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
