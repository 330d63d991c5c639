import hashlib

import numpy as np

from codesift.llm import suffix_dedup
from llm_data import corpus, empty, frame

WINDOW = 50


def brute_force(rows):
    """(n_bytes, n_removed, n_spans, digest) per row, from every 50-byte string of every document."""
    least = {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - WINDOW + 1):
            key = raw[i:i + WINDOW]
            if doc_id is not None and doc_id < least.get(key, 1 << 62):
                least[key] = doc_id
    out = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - WINDOW + 1):
            if doc_id is not None and least[raw[i:i + WINDOW]] < doc_id:
                gone[i:i + WINDOW] = b"\1" * WINDOW
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, rows):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute_force(rows), key=key)
    return got


def test_against_every_window(spark):
    got = compare(spark, corpus())
    assert sum(r[2] for r in got) > 10000


def test_window_borders(spark):
    a = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    rows = [(1, a), (2, "X" * 30 + a[100:150] + "Y" * 30), (3, "X1" * 20 + a[100:149] + "Z" * 9), (4, a[:50]), (5, a[-50:] + "é" * 30),
            (6, "é" * 30), (7, a[200:249] + "q" + a[249:299]), (8, "0" + a), (0, a[10:60])]
    compare(spark, [(i, t, "h", "s") for i, t in rows])


def test_empty(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_equal_windows_have_equal_names():
    rng = np.random.default_rng(1)
    seen = {}
    passage = rng.integers(0, 4, 90).astype(np.uint8)
    for size, letters in ((50, 4), (300, 2), (1000, 4), (200, 1), (120, 2)):
        codes = np.concatenate([rng.integers(0, letters, size).astype(np.uint8), passage, rng.integers(0, letters, 40).astype(np.uint8)])
        first, last, name = suffix_dedup.window_names(codes)
        assert first[0] == 0 and last[-1] == len(codes) - WINDOW and np.array_equal(first[1:], last[:-1] + 1)
        for a, b, n in zip(first, last, name):
            for i in range(a, b + 1):
                assert seen.setdefault(codes[i:i + WINDOW].tobytes(), n) == n


def test_names_streams_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    name = np.sort(rng.integers(0, 60, 300))
    doc = rng.integers(0, 3, 300)
    kind = np.zeros(300, np.int32)
    want = {n for n in set(name.tolist()) if len(set(doc[name == n].tolist())) > 1}
    cuts = [0, 1, 2, 50, 51, 200, 300]
    batches = [pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (name, doc, kind)], names=["name", "doc_id", "kind"])
               for a, b in zip(cuts, cuts[1:])]
    got = [(n, d) for b in suffix_dedup._shared_names(iter(batches)) for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert {n for n, _ in got} == want
    assert {(n, d) for n, d in got} == {(n, d) for n, d in zip(name.tolist(), doc.tolist()) if n in want}


def test_names_with_many_contexts(spark, monkeypatch):
    # every document has the passage, and its edges reach into the document's own text
    rows = corpus() + [(300 + i, f"{i * 7919:08d} own words {i} " + "the shared passage of all of them " * 3 + f" {i * 104729:08d} end", "h", "s")
                       for i in range(60)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    for limit, sent in ((200, 1_000_000), (3000, 1_000_000), (200, 0)):  # bytes of contexts; names that are broadcast
        monkeypatch.setattr(suffix_dedup, "MOST_SENT", sent)
        got = suffix_dedup.remove_repeats(frame(spark, rows), limit=limit).drop("kept").collect()
        assert sorted(map(tuple, got), key=key) == sorted(brute_force(rows), key=key)


def test_hot_names_are_told_once_across_batches():
    import pyarrow as pa

    name, doc = np.array([1] * 9 + [2] * 3 + [3] * 6), np.r_[np.arange(9), np.arange(3), np.zeros(6, int)]
    kind = np.full(18, 4, np.int32)
    for cuts in ([0, 18], [0, 1, 4, 8, 9, 10, 18], list(range(19))):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (name, doc, kind)], names=["name", "doc_id", "kind"])
                   for a, b in zip(cuts, cuts[1:])]
        out = [(n, d) for b in suffix_dedup._shared_names(iter(batches), limit=5) for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert [n for n, d in out if d is None] == [1]


def test_slices_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 3, 5000).astype(np.uint8)
    want = {i: n for a, b, n in zip(*(x.tolist() for x in suffix_dedup.window_names(codes))) for i in range(a, b + 1)}
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    got = {i: n for run in suffix_dedup.window_runs(codes) for a, b, n in zip(*(x.tolist() for x in run)) for i in range(a, b + 1)}
    assert got == want
    rows = corpus()
    for limit in (200, 1 << 20):
        got = suffix_dedup.remove_repeats(frame(spark, rows), limit=limit).drop("kept").collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(tuple, got), key=key) == sorted(brute_force(rows), key=key)


def test_repetitive_texts(spark):
    rows = [(i, "a" * (40 + 7 * i)) for i in range(40)] + [(100 + i, "=-" * (20 + 5 * i) + "!" * i) for i in range(30)]
    rows += [(200 + i, "one phrase again. " * (3 + i)) for i in range(20)]
    rows = [(i, t, "h", "s") for i, t in rows]
    want = sorted(brute_force(rows))
    for limit in (300, 5000, suffix_dedup.MOST):
        assert sorted(map(tuple, suffix_dedup.remove_repeats(frame(spark, rows), limit=limit).drop("kept").collect())) == want


MEMORY = """
import resource, sys
sys.path[:0] = [{repo!r}]
import numpy as np, pyarrow as pa
from codesift.llm import suffix_dedup as sd
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
def rows(texts, width):
    # (name, row_id, doc_id, places, context) as the contexts of these texts would arrive
    out = []
    for i, t in enumerate(texts):
        for first, last, name in sd.window_runs(sd._codes(t)):
            for a, b, n in zip(first.tolist(), last.tolist(), name.view(np.int64).tolist()):
                out.append((n, i, i, np.array([a], np.int32).tobytes(), t[a:b + sd.WINDOW].encode()))
    out.sort(key=lambda r: r[0])
    kinds = [pa.int64()] * 3 + [pa.binary()] * 2
    for low in range(0, len(out), 500):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[low:low + 500]), kinds)],
                                         names=["name", "row_id", "doc_id", "places", "context"])
texts = ["a" * (9_000 + i) for i in range(3000)]  # 31 MB, one name
hot = sd.window_names(sd._codes(texts[0]))[2].view(np.int64)
batch = lambda part, at: pa.RecordBatch.from_arrays([pa.array(range(at, at + len(part)), pa.int64())] * 2 + [
    pa.array(part), pa.array([[]] * len(part), pa.list_(pa.int64())), pa.array([hot.tolist()] * len(part), pa.list_(pa.int64()))],
    names=["row_id", "doc_id", "text", "names", "hot"])
seen = [sum(b.num_rows for i in range(0, 3000, 500) for b in sd._hot_windows(batch(texts[i:i + 500], i)))]
assert seen == [3000], seen
big = "".join(map(chr, np.random.default_rng(0).integers(97, 123, 20_000_000).astype(np.uint8)))
n = sum(b.num_rows for b in sd._name_rows(iter([pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([big])], names=["i", "t"])])))
assert n > 100_000
contexts = [t for t in rows(["word %d and some more text behind it, long enough to matter" % i * 40 for i in range(2000)], 0)]
out = sum(b.num_rows for b in sd._covered_rows(iter(contexts)))
print("MB", (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)
"""


def test_memory_stays_bounded():
    """3,000 texts of one letter, a text of 20 MB and 5 MB of contexts, one after the other in one process."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", MEMORY.format(repo=repo)], capture_output=True, text=True, timeout=300)
    assert "MB" in out.stdout, out.stderr[-1500:]
    assert int(out.stdout.split("MB")[1]) < 800


def test_windows_with_hot_names_across_batches():
    import pyarrow as pa

    rows = [(w, 10 * d + w, d, np.array([d, d + 50], np.int32).tobytes(), None) for w in (1, 2, 5) for d in (3, 3, 4, 9)]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 2
    for cuts in ([0, 12], [0, 1, 2, 3, 12], list(range(13))):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[a:b]), kinds)],
                                              names=["name", "row_id", "doc_id", "places", "context"]) for a, b in zip(cuts, cuts[1:])]
        got = sorted(r for b in suffix_dedup._covered_rows(iter(batches)) for r in b.column(0).to_pylist())
        assert got == sorted(10 * d + w for w in (1, 2, 5) for d in (4, 9))


def test_stripes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRIPE", 900)
    import pyarrow as pa
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(97, 99, 120))) for _ in range(40)] + ["shared text of the contexts " * 4] * 3
    rows = [(7, i, i, np.array([0], np.int32).tobytes(), t.encode()) for i, t in enumerate(texts)]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["name", "row_id", "doc_id", "places", "context"])
    found = [sorted((i, r) for b in suffix_dedup._covered(batch) for i, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))]
    monkeypatch.setattr(suffix_dedup, "STRIPE", 1 << 21)
    found.append(sorted((i, r) for b in suffix_dedup._covered(batch) for i, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    assert found[0] == found[1] and {i for i, _ in found[0]} >= {41, 42}
