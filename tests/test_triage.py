"""The six steps chained over two small repositories with a stand-in model, then re-run
over the stored answers: same findings, no new model call."""

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from codesift.plans.triage import triage
from codesift.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REPOS = {
    "shop": {
        "backend/controllers/user.js": "const q = 'SELECT * FROM users WHERE id=' + req.query.id;\ndb.query(q);\n",
        "backend/models/user.js": "const User = mongoose.model('User', schema);\nmodule.exports = User;\n",
        "frontend/view.jsx": "export default function V(p) {\n  return <div dangerouslySetInnerHTML={{__html: p.bio}} />;\n}\n",
        "README.md": "# shop\n",
        "test/user.test.js": "it('works', () => {});\n",
    },
    "blog": {
        "app.py": "import os\nos.system('ls ' + request.args['d'])\n",
        "node_modules/x/index.js": "module.exports = 1;\n",
    },
}


def model(batches):
    for pdf in batches:
        out = []
        for rid, op, msgs in zip(pdf["request_id"], pdf["operation"], pdf["messages_json"]):
            user = json.loads(msgs)[1]["content"]
            if op == "select-vuln-files":
                paths = user.split("FILES TO REVIEW:\n", 1)[1].split("\n")
                ans = "```json\n" + json.dumps([p for p in paths if not p.startswith("…")]) + "\n```"
            elif op == "summarise-and-imports":
                ans = json.dumps({"summary": "code", "imports": ["x"]})
            elif op == "group-subsets":
                files = [ln[2:].split(" [")[0] for ln in user.split("Files:\n", 1)[1].split("\n")]
                ans = json.dumps([{"subset_id": "all", "file_paths": files, "reason": "one app"}])
            elif op == "suggest-pipelines":
                ans = '["pipeline_injection"]'
            else:
                found = []
                for part in user.split("FILE: ")[1:]:
                    path = part.split("\n", 1)[0]
                    first = part.split("=====\n", 1)[1].split("\n", 1)[0]
                    found.append({"file_path": path, "code_snippet": first, "description": "d",
                                  "vulnerability": "SQL Injection", "severity": "High",
                                  "confidence_level": "Medium", "remediation": "r"})
                ans = json.dumps({"vulnerabilities": found})
            out.append((rid, ans, "ok"))
        yield pd.DataFrame(out, columns=["request_id", "content", "status"])


def _files(spark):
    rows = [(r, p, t) for r, fs in REPOS.items() for p, t in fs.items()]
    return spark.createDataFrame(rows, "repo_id string, path string, content string")


def test_triage_and_replay(spark):
    out = triage(_files(spark), provider=model)
    found = sorted((r.repo_id, r.file_path, tuple(r.line)) for r in out["findings"].collect())
    assert found == [("blog", "app.py", (1,)),
                     ("shop", "backend/controllers/user.js", (1,)),
                     ("shop", "backend/models/user.js", (1,)),
                     ("shop", "frontend/view.jsx", (1,))]
    m = {(r.repo_id, r.stage): r.n for r in out["metrics"].collect()}
    assert m[("shop", "listed")] == 5 and m[("shop", "kept")] == 3 and m[("blog", "listed")] == 1
    assert {r.subset_id for r in out["subsets"].collect()} == {"subset-001"}

    # every request of the first run, answered, becomes the stored table of the second run
    stored = None
    for key in ["selection_requests", "metadata_requests", "grouping_requests", "suggestion_requests", "scan_requests"]:
        part = out[key].select("request_id", "operation", F.to_json("messages").alias("messages_json"), "params_json")
        answered = part.mapInPandas(model, "request_id string, content string, status string")
        stored = answered if stored is None else stored.unionByName(answered)
    stored = materialize(stored)  # a table of answers, as it would be on disk

    def no_calls(batches):
        for pdf in batches:
            if len(pdf):
                raise AssertionError("model called on replay")
            yield pd.DataFrame({"request_id": [], "content": [], "status": []})

    again = triage(_files(spark), provider=no_calls, responses=stored)
    assert sorted((r.repo_id, r.file_path, tuple(r.line)) for r in again["findings"].collect()) == found
