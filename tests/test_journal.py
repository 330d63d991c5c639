"""M1: the answer journal.  Calls are counted as files in a shared folder, one per call."""

import os
import subprocess
import sys
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codesift.plans import model

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def requests_of(spark, n, copies=1):
    rows = spark.range(n * copies).select((F.col("id") % n).alias("k"))
    return model.with_request(rows, "ask", F.lit("system"), F.concat(F.lit("question "), F.col("k").cast("string")),
                              model.params(max_tokens=5))


def counting_provider(calls, dies=None, per_answer=3):
    """Answers ``per_answer`` requests at a time; ends its task after seven calls if the file ``dies`` does not exist yet."""
    def run(batches):
        import json

        import pandas as pd

        said = 0
        for pdf in batches:
            for low in range(0, len(pdf), per_answer):
                part = pdf.iloc[low:low + per_answer]
                if dies and said >= 7 and not os.path.exists(dies):
                    open(dies, "w").close()
                    os._exit(1)
                for i in part["request_id"]:
                    open(os.path.join(calls, f"{i}.{uuid.uuid4().hex}"), "w").close()
                    said += 1
                texts = [json.loads(m)[1]["content"] for m in part["messages_json"]]
                yield pd.DataFrame({"request_id": part["request_id"], "content": [f"answer to {t}" for t in texts], "status": "ok"})

    return run


def calls_of(folder):
    return Counter(x.split(".")[0] for x in os.listdir(folder))


def test_a_run_started_again_asks_only_for_the_rest(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    dies, journal = str(tmp_path / "died"), str(tmp_path / "journal")
    reqs = requests_of(spark, 60, copies=2)
    with pytest.raises(Exception):  # one task ends its process; a local session does not retry
        model.complete(reqs, counting_provider(str(calls), dies), partitions=2, journal=journal).count()
    before = calls_of(calls)
    assert 0 < len(before) < 60
    got = model.complete(reqs, counting_provider(str(calls), dies), partitions=3, journal=journal).collect()
    assert len(got) == 120 and all(r.content == f"answer to question {r.k}" and r.status == "ok" for r in got)
    after = calls_of(calls)
    assert len(after) == 60 and set(after.values()) == {1}
    # offline from the journal alone, and a third run calls nothing
    assert {r.status for r in model.complete(reqs, journal=journal).collect()} == {"ok"}
    model.complete(reqs, counting_provider(str(calls)), journal=journal).count()
    assert calls_of(calls) == after


def test_default_journal_belongs_to_one_call(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    for _ in range(2):
        assert model.complete(requests_of(spark, 5), counting_provider(str(calls))).count() == 5
    assert set(calls_of(calls).values()) == {2}


RETRY = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark.sql import SparkSession
from test_journal import counting_provider, requests_of
from codesift.plans import model
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4") \\
    .config("spark.checkpoint.dir", {ckpt!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
got = model.complete(requests_of(spark, 40), counting_provider({calls!r}, {dies!r}), partitions=2).collect()
assert sorted(r.content for r in got) == sorted(f"answer to question {{i}}" for i in range(40)), got
print("all answered")
"""


def test_a_retried_task_asks_nothing_twice(tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    dies = str(tmp_path / "died")
    script = RETRY.format(repo=REPO, tests=os.path.join(REPO, "tests"), ckpt=str(tmp_path / "ckpt"), calls=str(calls), dies=dies)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "all answered" in out.stdout, out.stderr[-2000:]
    assert os.path.exists(dies)  # the task was killed once
    assert len(calls_of(calls)) == 40 and set(calls_of(calls).values()) == {1}
