"""The incremental stream over several drops equals the batch result; changes and
in-batch duplicates are resolved like the batch path."""

import hashlib
import os
import tempfile

import pandas as pd

from codesift.streaming import incremental
from codesift.streaming.incremental import DROP_SCHEMA, current_metadata, incremental_metadata


def test_stream_drops(spark):
    base = tempfile.mkdtemp(prefix="codesift-stream-")
    drops = os.path.join(base, "drops")
    batches = [
        [("r", "a.js", "v1\n", 1), ("r", "b.js", "b\n", 2), ("r", "c.js", "old\n", 3), ("r", "c.js", "new\n", 4)],
        [("r", "a.js", "v2\nmore\n", 5)],
        [("r", "b.js", "b\n", 6)],      # same bytes again: unchanged
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, DROP_SCHEMA).coalesce(1).write.parquet(os.path.join(drops, f"d{i}"))
    q = incremental_metadata(spark, drops + "/*", os.path.join(base, "state"), os.path.join(base, "ckpt"),
                             max_files_per_trigger=1)
    q.awaitTermination()
    cur = {r.path: (r.sha1, r.loc, r.change) for r in current_metadata(spark, os.path.join(base, "state")).collect()}
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert cur["a.js"] == (sha("v2\nmore\n"), 3, "changed")
    assert cur["c.js"] == (sha("new\n"), 2, "new")          # last version within a batch wins
    assert cur["b.js"][0] == sha("b\n") and cur["b.js"][2] in ("new", "changed", "unchanged")
    log = spark.read.parquet(os.path.join(base, "state"))
    assert sorted(r.batch_id for r in log.select("batch_id").distinct().collect()) == [0, 1, 2]


def _provider():
    """Summaries named by the request; texts with the word BROKEN get a bad answer."""
    def answers(batches):
        import pandas as pd

        for pdf in batches:
            bad = pdf["messages_json"].str.contains("BROKEN")
            text = ["no json" if b else '{"summary": "s%s", "imports": []}' % i[:8] for b, i in zip(bad, pdf["request_id"], strict=True)]
            yield pd.DataFrame({"request_id": pdf["request_id"], "content": text, "status": "ok"})

    return answers


def _drop(spark, drops, name, rows):
    spark.createDataFrame(rows, DROP_SCHEMA).coalesce(1).write.parquet(os.path.join(drops, name))


def _run(spark, base, **kw):
    q = incremental_metadata(spark, os.path.join(base, "drops") + "/*", os.path.join(base, "state"), os.path.join(base, "ckpt"),
                             provider=_provider(), **kw)
    q.awaitTermination()
    return q


def test_batch_cost_does_not_grow(spark):
    """20 drops of two files each over 40 known files: every batch after the first writes two states and two log rows and never
    reads the log."""
    base = tempfile.mkdtemp(prefix="codesift-stream-")
    drops = os.path.join(base, "drops")
    _drop(spark, drops, "d00", [("r", f"f{i:02}.js", "v0", 0) for i in range(40)])
    for d in range(1, 20):
        _drop(spark, drops, f"d{d:02}", [("r", f"f{(2 * d + i) % 40:02}.js", f"v{d}", d) for i in range(2)])
    read = []
    latest, incremental._latest = incremental._latest, lambda *a: read.append(a)
    try:
        q = _run(spark, base, max_files_per_trigger=1)
    finally:
        incremental._latest = latest
    steps = [p for p in q.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in steps] == [40] + [2] * 19
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in steps] == [40] + [2] * 19
    assert steps[-1]["stateOperators"][0]["numRowsTotal"] == 40 and not read
    log = spark.read.parquet(os.path.join(base, "state"))
    assert {r["batch_id"]: r["count"] for r in log.groupBy("batch_id").count().collect()} == {0: 40} | {d: 2 for d in range(1, 20)}
    state = {r.path: (r.seq, r.sha1) for r in incremental.tracked_files(spark, os.path.join(base, "ckpt")).collect()}
    table = {r.path: r.sha1 for r in current_metadata(spark, os.path.join(base, "state")).collect()}
    assert len(state) == 40 and {p: s for p, (_, s) in state.items()} == table
    assert state["f02.js"][0] == 1 and state["f00.js"][0] == 0


def test_late_deleted_failed_and_compacted(spark):
    base = tempfile.mkdtemp(prefix="codesift-stream-")
    drops, state = os.path.join(base, "drops"), os.path.join(base, "state")

    def table():
        return {r.path: (r.sha1, r.summary_status) for r in current_metadata(spark, state).collect()}

    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    _drop(spark, drops, "a", [("r", "keep", "k", 5), ("r", "gone", "g", 5), ("r", "bad", "BROKEN", 5), ("r", "never", None, 5),
                              (None, None, "", None)])
    _run(spark, base)
    assert table() == {"keep": (sha("k"), "ok"), "gone": (sha("g"), "ok"), "bad": (sha("BROKEN"), "error"), None: (sha(""), "ok")}
    # a late version and an unchanged one write nothing, a null content deletes, the failed file is asked again
    _drop(spark, drops, "b", [("r", "keep", "older", 4), ("r", "gone", None, 6), ("r", "bad", "BROKEN", 6)])
    _run(spark, base)
    log = spark.read.parquet(state)
    assert sorted((r.path, r.change) for r in log.filter("batch_id = 1").collect()) == [("bad", "changed"), ("gone", "deleted")]
    assert table() == {"keep": (sha("k"), "ok"), "bad": (sha("BROKEN"), "error"), None: (sha(""), "ok")}
    assert incremental.compact(spark, state) == 1 and incremental.compact(spark, state) == 1
    assert not [x for x in os.listdir(state) if x.startswith("batch_id=")]
    # behind the snapshot: the deleted path does not come back by a late version, but by a newer one; the failure is mended
    _drop(spark, drops, "c", [("r", "gone", "late", 5), ("r", "bad", "fine", 7)])
    _run(spark, base)
    assert table() == {"keep": (sha("k"), "ok"), "bad": (sha("fine"), "ok"), None: (sha(""), "ok")}
    _drop(spark, drops, "d", [("r", "gone", "again", 8), ("r", "bad", "fine", 8)])
    _run(spark, base)
    assert table()["gone"] == (sha("again"), "ok") and table()["bad"] == (sha("fine"), "ok")
    assert sorted(r.path for r in spark.read.parquet(state).filter("batch_id = 3").collect()) == ["gone"]
    assert spark.read.schema(incremental.PENDING_SCHEMA).parquet(f"{state}_pending/batch_id=3").count() == 0


def test_timer_forgets_deleted_files(spark):
    base = tempfile.mkdtemp(prefix="codesift-stream-")
    drops = os.path.join(base, "drops")
    for name, rows in [("a", [("r", "x", "x", 1), ("r", "y", "y", 1)]), ("b", [("r", "x", None, 2)]), ("c", [("r", "z", "z", 3)])]:
        _drop(spark, drops, name, rows)
        _run(spark, base, expire_deleted_ms=1)
    left = incremental.tracked_files(spark, os.path.join(base, "ckpt")).collect()
    assert sorted(r.path for r in left) == ["y", "z"]


def test_python_holds_bounded_batches(spark):
    """Long contents fill a result batch by their length, paths without an event fill it too, and a batch has few rows; the extra
    rows are no events."""
    class State:
        def __init__(self, value=None, timed_out=False):
            self.exists, self.get, self.hasTimedOut = value is not None, value, timed_out

        def update(self, value):
            self.get = value

        def remove(self):
            self.get = None

    def rows(content, seq, state):
        frame = pd.DataFrame({"content": [content], "seq": [seq], "sha1": ["h"]})
        return pd.concat(incremental._track(None)(("r", "p"), iter([frame]), state))

    most = incremental.FRAME_BYTES // incremental.FRAME_ROWS
    long = rows("x" * (10 * most), 1, State())
    assert len(long) == 11 and long["change"].tolist() == ["new"] + [None] * 10 and long["content"].notna().sum() == 1
    late = rows("old", 1, State((2, "h")))
    assert late["change"].tolist() == [None]
    assert len(pd.concat(incremental._track(1)(("r", "p"), iter([]), State((2, None), timed_out=True)))) == 1
    own = incremental._stream_session(spark)
    assert int(own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= incremental.FRAME_ROWS
    assert int(own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == incremental.FRAME_BYTES

    base = tempfile.mkdtemp(prefix="codesift-stream-")
    drops, text = os.path.join(base, "drops"), "y" * (3 * most)
    _drop(spark, drops, "a", [("r", "long", text, 2), ("r", "short", "s", 2)])
    _run(spark, base)
    _drop(spark, drops, "b", [("r", "long", "late", 1), ("r", "short", "s", 3)])
    _run(spark, base)
    log = spark.read.parquet(os.path.join(base, "state"))
    assert sorted((r.path, r.change, r.sha1) for r in log.collect()) == [
        (p, "new", hashlib.sha1(t.encode()).hexdigest()) for p, t in (("long", text), ("short", "s"))]
