from collections import Counter, defaultdict

import pytest

from codesift.llm import sharding
from codesift.llm.queries import q_virtual_slots
from conftest import SF_SMALL
from llm_data import corpus, empty, frame


def test_every_row_once_gapless_and_balanced(spark):
    rows = q_virtual_slots(spark, SF_SMALL).collect()
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert len(rows) == n and len({r.doc_id for r in rows}) == n
    by_shard, load = defaultdict(list), Counter()
    for r in rows:
        by_shard[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert set(by_shard) <= set(range(24))
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    # whole slots are dealt, largest first: no shard exceeds the mean by more than the largest slot
    slots = Counter()
    for r in rows:
        slots[r.vslot] += r.size
    mean = sum(load.values()) / 24
    assert max(load.values()) <= mean + max(slots.values())


def test_defined_cases(spark):
    rows = corpus()
    placed, slot_map = sharding.assign(frame(spark, rows), 5)
    got = placed.collect()
    assert len(got) == len(rows)
    assert {r.size for r in got if r.doc_id == 200} == {8}
    again = {(r.doc_id, r.size, r.text_crc32): r.shard for r in sharding.assign(frame(spark, rows), 5, slot_map)[0].collect()}
    assert all(again[r.doc_id, r.size, r.text_crc32] == r.shard for r in got)
    nothing, even = sharding.assign(empty(spark), 5)
    assert nothing.count() == 0 and max(Counter(even.shards).values()) - min(Counter(even.shards).values()) <= 1


def test_growing_moves_slots_only_into_new_shards():
    sizes = {i: (i * 7919) % 1000 + 1 for i in range(sharding.N_SLOTS)}
    old = sharding.build_map(sizes, 24)
    new = sharding.grow(old, sizes, 26)
    assert new.version == old.version + 1
    moved = [i for i in range(sharding.N_SLOTS) if old.shards[i] != new.shards[i]]
    assert moved and all(new.shards[i] >= 24 for i in moved)
    load = Counter()
    for i, s in enumerate(new.shards):
        load[s] += sizes[i]
    assert max(load.values()) < 1.1 * sum(load.values()) / 26 and min(load.values()) > 0.9 * sum(load.values()) / 26


def test_stored_versions_place_and_move_rows(spark, tmp_path):
    path = str(tmp_path / "maps")
    assert sharding.stored_map(spark, path) is None
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first, one = sharding.assign(docs, 24, map_path=path)
    before = {r.doc_id: (r.vslot, r.shard) for r in first.collect()}
    assert one == sharding.stored_map(spark, path) == sharding.stored_map(spark, path, 1)
    with pytest.raises(Exception):
        one.save(spark, path)  # a version is never overwritten

    two = sharding.rebalance(spark, path, sharding.slot_sizes(sharding.with_slots(docs)), 26)
    assert two == sharding.stored_map(spark, path) and two.version == 2 and sharding.stored_map(spark, path, 1) == one
    second, used = sharding.assign(docs, 24, map_path=path)
    after = {r.doc_id: (r.vslot, r.shard) for r in second.collect()}
    assert used == two and {i: v for i, (v, _) in before.items()} == {i: v for i, (v, _) in after.items()}
    moved = {i for i in before if before[i] != after[i]}
    assert moved and all(after[i][1] >= 24 for i in moved)


def test_an_id_used_often_and_long_texts(spark):
    rows = [(7, f"text {i} of one id", "h", "s") for i in range(400)] + [(i, "x" * 300_000, "h", "s") for i in range(100, 104)]
    got = sharding.assign(frame(spark, rows), 3)[0].collect()
    assert len(got) == 404
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    cells = Counter((r.vslot, r.cell) for r in sharding.with_slots(frame(spark, rows)).collect() if r.doc_id == 7)
    assert len(cells) > 4 and max(cells.values()) < 100
