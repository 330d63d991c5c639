"""Fill-in-the-middle rewriting against plain string slicing, and the chunk summaries it rests on."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codesift.llm import fill_middle as fm
from llm_data import corpus, empty, frame, prose


def plainly(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slicing the string."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


PIECES = st.sampled_from(["a", "é", "漢", "😀", "<", "P", "S>", "<M>", "<S", "word ", "\n", "x" * 70, "né " * 40, "日本" * 900])


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**12), st.lists(PIECES, max_size=30))
def test_equals_slicing(doc_id, pieces):
    text = "".join(pieces)
    n, form, a, b, out = fm.rewrite(doc_id, text.encode(), fm.SummaryCache(4000))
    assert (n, form, a, b, out.decode()) == plainly(doc_id, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=12), st.lists(st.integers(0, 400), max_size=6))
def test_summaries_combine_at_any_cut(pieces, cuts):
    raw = "".join(pieces).encode()
    whole, last = fm.Summary(0, False, b"", b""), 0
    for cut in [*sorted(c for c in cuts if c <= len(raw)), len(raw)]:  # also inside a code point or marker
        whole, last = fm.combine(whole, fm.summarize(raw[last:cut])), cut
    assert whole == fm.summarize(raw)


def test_chunks_follow_content():
    rng = random.Random(3)
    shared = prose(rng, 3000)
    a, b = (prose(rng, 500) + shared).encode(), (prose(rng, 900) + shared).encode()
    chunks = [{x[i:j] for i, j in zip([0, *fm.chunk_ends(x)], fm.chunk_ends(x))} for x in (a, b)]
    assert sum(map(len, chunks[0] & chunks[1])) > 0.8 * len(shared.encode())
    for raw in (a, b, b"x" * 100_000, b""):
        ends = fm.chunk_ends(raw)
        sizes = [j - i for i, j in zip([0, *ends], ends)]
        assert sum(sizes) == len(raw) and all(fm.MIN_CHUNK <= s <= fm.MAX_CHUNK for s in sizes[:-1])
    cache = fm.SummaryCache()
    fm.Text(a, cache)
    before = cache.computed
    fm.Text(a, cache)
    assert cache.computed == before  # all from the cache


def test_slices_change_nothing(monkeypatch):
    raw = prose(random.Random(4), 4000).encode()
    want = fm.chunk_ends(raw)
    monkeypatch.setattr(fm, "SLICE", 1000)
    assert fm.chunk_ends(raw) == want


def test_cache_is_bounded_and_keeps_what_is_used():
    cache = fm.SummaryCache(1000)
    for i in range(500):
        cache.get(b"hot" * 30)
        cache.get(f"cold {i}".encode() * 8)
    assert sum(map(len, cache._new)) + sum(map(len, cache._old)) <= 2200
    assert cache.computed == 501  # the hot chunk once, each cold chunk once


def test_table(spark):
    long_text = "漢字 and words, " * 300_000
    rows = corpus() + [(900, "ends with <S", "h", "s"), (901, "<M>", "h", "s"), (902, long_text, "h", "s"), (902, long_text, "h", "s"),
                       (903, "é" * 50_000, "h", "s")]
    got = fm.fill_in_middle(frame(spark, rows)).withColumn("back", fm.restored(F.col("output"), F.col("form")))
    rows_out = got.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(((i, t or "", *plainly(i, t or "")) for i, t, *_ in rows), key=key)
    found = sorted(((r.doc_id, r.back, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows_out), key=key)
    assert found == want
    assert {r.form for r in rows_out} == {"plain", "psm", "spm"}
    assert fm.fill_in_middle(empty(spark)).count() == 0
