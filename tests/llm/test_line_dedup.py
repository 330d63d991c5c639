import random
import re

from codesift.llm import line_dedup
from llm_data import corpus, empty, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows):
    """Kept text and counts per (doc_id, text), from the longest common prefix of every two suffixes."""
    docs = sorted({(r[0], r[1]) for r in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    solid = [[x for x in (text or "").split("\n") if WORD.search(x)] for _, text in docs]
    places = {}
    for d, lines in enumerate(solid):
        for i, line in enumerate(lines):
            places.setdefault(line, []).append((d, i))
    gone = [set() for _ in docs]
    for at in places.values():
        for n, (d, i) in enumerate(at):
            for e, j in at[:n]:
                if i and j and solid[d][i - 1] == solid[e][j - 1]:
                    continue  # the run is longer to the left
                k = 0
                while i + k < len(solid[d]) and j + k < len(solid[e]) and solid[d][i + k] == solid[e][j + k]:
                    k += 1
                if sum(len(WORD.findall(x)) for x in solid[d][i:i + k]) >= 20:
                    gone[d].update(range(i, i + k))
    out = {}
    for (doc_id, text), lines, away in zip(docs, solid, gone):
        kept, nth = [], 0
        for line in (text or "").split("\n"):
            is_solid = bool(WORD.search(line))
            if not (is_solid and nth in away):
                kept.append(line)
            nth += is_solid
        out[doc_id, text] = ("\n".join(kept) if text is not None else None, nth, len(away))
    return out


def test_against_every_pair_of_suffixes(spark):
    # two rows with one id but different texts have no defined order; leave that id to the next test
    rows = [r for r in corpus() if r[0] not in (5, None)]
    want = brute_force(rows)
    key = {r[0]: r[1] for r in rows}
    got = line_dedup.delete_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.doc.text, r.n_lines, r.n_deleted) == want[r.doc.doc_id, key[r.doc.doc_id]], r.doc.doc_id
    assert sum(r.n_deleted for r in got) > 100


def test_nulls_repeats_and_clashing_names(spark):
    rows = corpus()
    df = frame(spark, rows)
    kept = line_dedup.keep_first_copies(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) >= 1 and None in ids and 200 in ids and 201 in ids
    assert not set(range(120, 132)) & set(ids)  # whole copies go
    assert line_dedup.keep_first_copies(empty(spark)).count() == 0
    assert line_dedup.repeated_runs(empty(spark)).count() == 0


def test_repeated_row_keeps_the_same_lines(spark):
    text = "\n".join(f"line number {i} has these six words" for i in range(9))
    rows = [(1, text, "h", "s")] * 2 + [(2, "new first line\n" + text, "h", "s")]
    got = {(r.doc.doc_id, r.doc.text) for r in line_dedup.delete_repeats(frame(spark, rows)).collect()}
    assert got == {(1, text), (2, "new first line")}


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_lines_of_unequal_length(spark):
    run = [words(30, "a"), words(10, "b"), words(5, "c")]
    short = [words(7, "d"), words(6, "e"), words(6, "f")]
    rows = [(1, "\n".join(run), "h", "s"), (2, "\n".join(["own", *run, "own end"]), "h", "s"), (3, "\n".join(run[1:]), "h", "s"),
            (4, "\n".join(["x", *short, "y"]), "h", "s"), (5, "\n".join([*short, "z"]), "h", "s"),
            (6, "\n".join([words(3, "g"), *short]), "h", "s"), (7, "\n".join(["q", words(3, "g"), *short, "\n", "r"]), "h", "s")]
    got = {r.doc.doc_id: r for r in line_dedup.delete_repeats(frame(spark, rows)).collect()}
    want = brute_force(rows)
    assert all((got[i].doc.text, got[i].n_lines, got[i].n_deleted) == want[i, t] for i, t, *_ in rows)
    assert got[2].doc.text == "own\nown end"  # the whole run of 45 words goes, with its short last lines
    assert got[3].n_deleted == 0 and got[5].n_deleted == 0  # 15 and 19 words
    assert got[7].doc.text == "q\n\n\nr" and got[7].n_deleted == 4
    runs = {(r.doc_id, r.start, r.n_lines) for r in line_dedup.repeated_runs(frame(spark, rows)).collect()}
    assert runs == {(2, 1, 3), (7, 1, 4)}


def test_random_lines_against_common_prefixes(spark):
    rng = random.Random(11)
    lines = [words(rng.choice([1, 2, 3, 5, 8, 13, 19, 20, 25]), f"l{i}x") for i in range(14)]
    rows = []
    for i in range(60):
        picked = [rng.choice(lines) for _ in range(rng.randint(0, 14))]
        if i % 3 and rows:
            other = rows[rng.randrange(len(rows))][1].split("\n")
            a = rng.randrange(len(other))
            picked[len(picked) // 2:len(picked) // 2] = other[a:a + rng.randint(1, 9)]
        rows.append((i, "\n".join(picked), "h", "s"))
    want = brute_force(rows)
    got = line_dedup.delete_repeats(frame(spark, rows)).collect()
    key = {r[0]: r[1] for r in rows}
    assert all((r.doc.text, r.n_lines, r.n_deleted) == want[r.doc.doc_id, key[r.doc.doc_id]] for r in got)
    assert sum(r.n_deleted for r in got) > 50


def test_long_text(spark):
    text = "\n".join(f"line {i} of a long text" for i in range(30_000))
    rows = [(1, text, "h", "s"), (2, "first\n" + text + "\nlast words", "h", "s")]
    got = {r.doc.doc_id: r for r in line_dedup.delete_repeats(frame(spark, rows)).collect()}
    assert (got[1].n_deleted, got[2].n_deleted, got[2].doc.text) == (0, 30_000, "first\nlast words")


def test_counts_of_the_tables(spark):
    for sf, deleted in (("0.001", 177), ("0.01", 1004)):
        docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
        assert sum(r.n_deleted for r in line_dedup.delete_repeats(docs).select("n_deleted").collect()) == deleted


def test_maximal_runs(spark):
    block = "\n".join(f"line number {i} has these six words" for i in range(9))
    rows = [(1, block, "h", "s"), (2, "start\n" + block + "\nend", "h", "s")]
    runs = [(r.doc_id, r.start, r.n_lines) for r in line_dedup.repeated_runs(frame(spark, rows)).collect()]
    assert runs == [(2, 1, 9)]
