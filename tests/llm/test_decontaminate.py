import random
import time

from codesift.llm import decontaminate
from llm_data import corpus, empty, frame, prose


def nearest(pattern, text):
    """(distance, first end) by the full table of edit distances."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def test_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(800):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert decontaminate.best_match(pattern, text) == nearest(pattern, text)


def edited(rng, text, k):
    chars = list(text)
    for _ in range(k):
        at = rng.randrange(len(chars))
        what = rng.random()
        if what < 0.4:
            chars[at] = rng.choice("xyz")
        elif what < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def test_against_the_full_distance(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(5, 40)).replace("\n", " ")) for i in range(12)] + [(50, None), (51, ""), (52, "  "), (53, "short"), (54, None)]
    items.append((55, items[0][1]))  # an equal item under another id
    rows = corpus()
    for i in range(24):
        item = items[i % 12][1]
        k = decontaminate.edit_budget(len(item))
        rows.append((500 + i, prose(rng, 30) + " " + edited(rng, item, [0, k, k + 4][i % 3]).upper() + "\n" + prose(rng, 30), "h", "s"))
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' as doc_id", "1 as start")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, rows), bench).collect()}
    want = set()
    for doc_id, text, *_ in rows:
        for item_id, item in items:
            pattern = decontaminate.fold(item or "").strip()
            # the full table is slow: texts of up to 700 characters
            if pattern and text and len(text) < 700:
                if nearest(pattern, decontaminate.fold(text))[0] <= decontaminate.edit_budget(len(pattern)):
                    want.add((doc_id, item_id))
    short = {r[0] for r in rows if r[1] and len(r[1]) < 700}
    assert {x for x in got if x[0] in short} == want
    assert len(want) > 15
    kept = decontaminate.drop_leaks(frame(spark, rows), bench)
    leaking = {d for d, _ in got}
    assert kept.columns == frame(spark, rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in leaking or r[0] is None and None not in leaking)


def test_blocks_and_empty_tables(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(rng, 30)) for i in range(9)]
    rows = [(i, prose(rng, 10) + " " + t, "h", "s") for i, t in items]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)
    got = decontaminate.find_leaks(frame(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(i, i, 0) for i in range(9)]
    assert decontaminate.drop_leaks(frame(spark, rows), bench).count() == 0
    assert decontaminate.find_leaks(empty(spark), bench).count() == 0
    assert decontaminate.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(frame(spark, rows), bench.limit(0)).count() == 9


def test_positions():
    items = decontaminate.Items([(1, "the quick brown fox jumps over the lazy dog by the river")])
    text = "XX The quick\nbrown fox jumps over the lazy dog by the river YY"
    assert items.leaks(text) == [(1, 3, 59, 0)]
    assert items.leaks(text.replace("fox", "f0x")) == [(1, 3, 59, 1)]


def test_repetitive_texts_cost_their_length():
    item = "a" * 420
    items = decontaminate.Items([(1, item)])
    for n in (380, 1000, 2000):
        begun = time.perf_counter()
        found = items.leaks("a" * n)
        assert time.perf_counter() - begun < 0.3
        assert bool(found) == (n >= 420 - decontaminate.edit_budget(420))
        assert all(d == 0 for _, a, b, d in found if n >= 420 and b - a == 420)
    many = decontaminate.Items([(i, c * (60 + i)) for i in range(60) for c in ("=-", "ab")])
    begun = time.perf_counter()
    text = "=-" * 10_000
    assert {i for i, *_ in many.leaks(text)} == set(range(60)) and many.any_leak(text)
    assert time.perf_counter() - begun < 30


def test_long_texts_and_neighbouring_occurrences():
    rng = random.Random(8)
    item = prose(rng, 30).replace("\n", " ")
    items = decontaminate.Items([(1, item)])
    filler = prose(rng, 60_000)
    text = filler + " " + item + " " + item + " " + edited(rng, item, 3) + " " + filler
    found = items.leaks(text)
    assert [(d <= 3) for *_, d in found] == [True] * 3 and [d for *_, d in found][:2] == [0, 0]
    start = len(filler) + 1
    assert [(a, b) for _, a, b, _ in found][:2] == [(start, start + len(item)), (start + len(item) + 1, start + 2 * len(item) + 1)]


def test_every_occurrence_by_the_full_table():
    """Each text position where the whole table falls to the budget lies within twice the budget of a reported end."""
    rng = random.Random(4)
    for _ in range(60):
        item = "".join(rng.choice("ab") for _ in range(rng.choice([16, 33, 45, 64])))
        k = decontaminate.edit_budget(len(item))
        text = "".join(rng.choice("ab") for _ in range(20)).join(edited(rng, item, rng.randint(0, k + 2)) for _ in range(4))
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        ends = [j for j, d in enumerate(row) if d <= k]
        found = decontaminate.Items([(1, item)]).leaks(text)
        assert all(any(abs(b - j) <= 2 * k for _, _, b, _ in found) for j in ends)
        assert all(row[b] == d <= k for _, _, b, d in found) and decontaminate.Items([(1, item)]).any_leak(text) == bool(ends)
