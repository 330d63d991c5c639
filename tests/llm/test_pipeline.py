"""The stages against plain statements of what each has to keep."""

import corpus_pipeline
from codesift.llm import decontaminate
from codesift.sources.corpus import read_table
from codesift.llm.staging import staged
from conftest import SF_SMALL
from test_line_dedup import brute_force as lines_brute_force
from test_ngram_join import brute_force as groups_brute_force
from test_quality import repeated


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}

    kept = staged(corpus_pipeline.quality_rules(spark, docs, SF_SMALL), "t")
    assert kept.columns == columns
    after = {r.doc_id: r.text for r in kept.collect()}
    want = {i: t for i, t in before.items() if len(t.split()) >= 20 and 100 * repeated(t.split()) <= 30 * len(t.split())}
    assert after == want  # no host is rejected here

    before, docs = after, kept
    kept = staged(corpus_pipeline.line_runs(spark, docs, SF_SMALL), "t")
    assert kept.columns == columns
    rows = kept.collect()
    lines = lines_brute_force([(i, t) for i, t in before.items()])
    want = {i: text for (i, _), (text, n, gone) in lines.items() if gone < n or not gone}
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    before, docs = want, kept
    kept = staged(corpus_pipeline.near_duplicates(spark, docs, SF_SMALL), "t")
    groups = groups_brute_force([(i, t) for i, t in before.items()], 5, 80)
    want = {i: before[i] for i, _, group in groups if i == group}
    assert {r.doc_id: r.text for r in kept.collect()} == want and kept.columns == columns

    docs = kept
    kept = staged(corpus_pipeline.decontamination(spark, docs, SF_SMALL), "t")
    items = [decontaminate.fold(r.text).strip() for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    leaking = {i for i, t in want.items() if any(x in decontaminate.fold(t) for x in items)}
    got = {r.doc_id: r.text for r in kept.collect()}
    assert leaking and not leaking & set(got) and kept.columns == columns
    assert set(want) - leaking - set(got) == set()  # the planted passages are exact here

    pieces = corpus_pipeline.pack(spark, kept, SF_SMALL).collect()
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert set(total) == set(got) and all(total[r.doc_id] == r.doc_tokens for r in pieces)


def test_run_equals_the_stages(spark):
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert pieces and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"
    docs = read_table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_SMALL), "t")
    assert sorted(map(tuple, docs.drop("sequence_id", "offset").collect())) == sorted(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces)
