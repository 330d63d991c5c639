import random
import re

import numpy as np
import pytest

from codesift.llm import ngram_join
from codesift.llm.prefix_tree import PrefixTree
from llm_data import corpus, empty, frame


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_force(rows, n, percent):
    """(doc_id, set size, smallest id reachable) per row, from all pairs."""
    sets = [shingles(t, n) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if r[0] is not None and top(j) == top(i)]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


def chains(rng):
    """Documents that link only along a chain, and families whose members link through one document only."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(14):
        rows.append((1000 + k, " ".join(words[8 * k:8 * k + 200])))
    centre = [f"c{i}" for i in range(240)]
    rows.append((1500, " ".join(centre)))
    for k in range(10):
        edited = list(centre)
        for _ in range(3):
            edited[rng.randrange(len(edited))] = f"e{rng.random()}"
        rows.append((1501 + k, " ".join(edited)))
    return [(i, t, "h", "s") for i, t in rows]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 60)])
def test_against_all_pairs(spark, n, percent):
    rows = corpus() + chains(random.Random(4))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_groups(frame(spark, rows), n, percent).collect()]
    assert ordered(got) == ordered(brute_force(rows, n, percent))


def test_keep_one_per_group(spark):
    rows = corpus()
    kept = ngram_join.keep_one_per_group(frame(spark, rows)).collect()
    assert set(kept[0].asDict()) == {"doc_id", "text", "source", "row_id", "lines", "doc", "class"}
    want = {(r[0], r[2]) for r in brute_force(rows, 5, 80)}
    ids = [r.doc_id for r in kept]
    for doc_id, group in want:
        if doc_id is not None and doc_id not in (5, 200, 201, 202):
            assert (doc_id in ids) == (doc_id == group)
    assert {200, 201, 202} <= set(ids)
    assert ngram_join.keep_one_per_group(empty(spark)).count() == 0
    assert ngram_join.similar_groups(empty(spark)).count() == 0


def test_prefix_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 62, 60).astype(np.uint64))
    sets = []
    for _ in range(120):
        keep = base[rng.random(len(base)) < rng.choice([0.5, 0.9, 0.97, 1.0])]
        extra = rng.integers(0, 1 << 62, rng.integers(0, 6)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([keep, extra])))
    sets = [s for s in sets if len(s)]
    for percent in (50, 80, 90, 100):
        tree = PrefixTree(sets)
        for probe in sets[:40]:
            want = [i for i, s in enumerate(sets) if (k := len(np.intersect1d(s, probe))) * 100 >= percent * (len(s) + len(probe) - k)]
            assert sorted(tree.similar(probe, percent)) == want


def test_linked_sets_share_a_branch():
    rng = random.Random(6)
    for percent in (50, 80, 90):
        ranges = ngram_join.Ranges(percent)
        for _ in range(1500):
            size = rng.randint(1, 120)
            a = {rng.getrandbits(64) for _ in range(size)}
            b = set(a)
            for _ in range(rng.randint(0, max(1, size * (100 - percent) // 100))):
                if rng.random() < 0.5 and len(b) > 1:
                    b.remove(rng.choice(sorted(b)))
                else:
                    b.add(rng.getrandbits(64))
            both = len(a & b)
            if a != b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = ({space: (kind, set(found.tolist())) for space, kind, found in ranges.branches(np.array(sorted(s), np.uint64))}
                        for s in (a, b))
                assert any(len(x[c][1] & y[c][1]) >= max(x[c][0] >> 1, y[c][0] >> 1) > 0 and (x[c][0] | y[c][0]) & 1
                           for c in set(x) & set(y))


def test_streams_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(7)
    branch = np.sort(rng.integers(0, 80, 400))
    own = rng.integers(0, 5, 400)
    order = np.lexsort((own, branch))
    branch, own = branch[order], own[order]
    want = set()
    for b in set(branch.tolist()):
        classes = sorted(set(own[branch == b].tolist()))
        if len(classes) > 1:
            want |= {(b, c) for c in classes}
    cuts = [0, 1, 2, 3, 90, 91, 300, 400]
    batches = [pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (branch, own, own, own)], names=ngram_join.BRANCH_COLUMNS)
               for a, b in zip(cuts, cuts[1:])]
    got = [tuple(r.values())[:2] for b in ngram_join._meetings(iter(batches)) for r in b.to_pylist()]
    assert len(got) == len(set(got)) and set(got) == want


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], b[:20]]))
        x, y = (np.frombuffer(ngram_join.bitmap(s), np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def templated(n, seed=5):
    """Texts of one template with own words, all alike on the template and hardly ever linked, and some linked pairs."""
    rng = random.Random(seed)
    template = [f"fixed{i}" for i in range(26)]
    rows = []
    for i in range(n):
        own = [f"own{rng.randrange(10 ** 9)}" for _ in range(18)]
        if i % 40 == 1:
            own = rows[-1][1].split()[26:]
            own[3] = "changed"
        rows.append((i, " ".join(template + own), "h", "s"))
    return rows


def test_one_templated_family(spark, monkeypatch):
    rows = templated(700)
    monkeypatch.setattr(ngram_join, "OPEN_BLOCK", 32)
    largest = []
    whole = ngram_join.open_cells
    def cells(left, sets):
        out = whole(left, sets)
        sizes = out.groupBy("branch", "probes", "members").count().agg({"count": "max"}).first()[0]
        hot = left.groupBy("branch").count().agg({"count": "max"}).first()[0]
        largest.append((sizes or 0, hot or 0))
        return out
    monkeypatch.setattr(ngram_join, "open_cells", cells)
    for n, percent in ((3, 90), (3, 80)):
        got = ngram_join.similar_groups(frame(spark, rows), n, percent)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute_force([r[:2] for r in rows], n, percent))
    blocks = max(32, 16 * 700 ** 0.5)
    assert all(size <= 4 * blocks for size, _ in largest)


def test_blocks_of_a_branch_lose_no_pair(spark, monkeypatch):
    """Open branches that hold far more sets than a block, with links across all blocks."""
    left = [(b, c, c if c % 5 else 0, 0, 2 * 2 + 1) for c in range(200) for b in (1 << 60, 1 << 61, (1 << 62) + c // 2)]
    sets = [(c, 40, bytes(256)) for c in range(200)]
    df = spark.createDataFrame(left, "branch bigint, class bigint, root bigint, space int, kind int")
    shapes = spark.createDataFrame(sets, "class bigint, n_shingles bigint, bits binary")
    want = {(a, b) for a in range(200) for b in range(a) if (a if a % 5 else 0) != (b if b % 5 else 0)}
    seen = []
    for block in (7, 10_000):
        monkeypatch.setattr(ngram_join, "OPEN_BLOCK", block)
        monkeypatch.setattr(ngram_join.F, "sqrt", lambda c: ngram_join.F.lit(0.1))
        cells = ngram_join.open_cells(df, shapes)
        pairs = cells.repartition(3, "branch", "probes", "members").sortWithinPartitions("branch", "probes", "members", "role") \
            .mapInArrow(ngram_join._open_pairs(90), "hub bigint, class bigint").collect()
        got = [(max(r), min(r)) for r in map(tuple, pairs)]
        assert len(got) == len(set(got)) and set(got) == want
        seen.append(cells.groupBy("branch", "probes", "members").count().agg({"count": "max"}).first()[0])
    assert seen[0] < 80 < seen[1]
