"""Rule screening, a provider that needs no model.

A rule table (configuration, a list or a DataFrame of any number of rules) is applied to every line of every file; matches
come out in the finding shape (D7).  Most patterns cannot match without some literal text (``required_literals``): one
Aho-Corasick scan per file finds the literals of all rules at once, and only the (line, rule) candidates it gives run their
pattern, joined to the rule table.  Rules without such a literal are compiled into native expressions over all lines.
Patterns are matched by the JVM in either case.  Not claimed equal to a model's findings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as op
from re import _parser as parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.functions.text import split_lines

# Rule set used by the built-in screen.  Each targets a class named in the catalog.
DEFAULT_RULES = [
    {"rule_id": "inline_script", "pattern": "(?i)<script", "vulnerability": "Cross-Site Scripting",
     "severity": "Low", "pipeline_id": "pipeline_xss"},
    {"rule_id": "inner_html", "pattern": "innerHTML|dangerouslySetInnerHTML", "vulnerability": "DOM XSS",
     "severity": "Medium", "pipeline_id": "pipeline_xss"},
    {"rule_id": "hex_secret", "pattern": "\\b[0-9a-f]{40}\\b", "vulnerability": "Hard-coded secret",
     "severity": "High", "pipeline_id": "pipeline_auth"},
    {"rule_id": "sql_concat", "pattern": "(?i)select .* from .*['\"] *\\+", "vulnerability": "SQL Injection",
     "severity": "High", "pipeline_id": "pipeline_injection"},
]
#: Rules without a literal that are compiled into one expression; more of them are further passes over the lines.
RULES_AT_ONCE = 500
#: A rule table is configuration: its patterns are held by every task.
MAX_RULE_BYTES = 64 << 20
SHORTEST_LITERAL = 3
RULE_FIELDS = ["rule_id", "pipeline_id", "vulnerability", "severity"]
#: Constructs that the two regex dialects read differently; such patterns are not analysed.
_OTHER_DIALECT = re.compile(r"\\[0-9v]|\(\?[a-zA-Z]*[ux]|\[[^\]]*&&")


def _ascii_lower(text: str) -> str:
    """A-Z in lower case; positions stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _needs(items) -> list[set[str]]:
    """Sets of literals of which every match of the sequence holds at least one each."""
    found: list[set[str]] = []
    run = ""
    for kind, value in items:
        if kind is op.LITERAL:
            run += chr(value)
            continue
        if kind is op.AT:  # a position; what stands around it stays adjacent
            continue
        if run:
            found.append({run})
        run = ""
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
            found += _needs(value[2])
        elif kind is op.SUBPATTERN and not value[1] and not value[2]:
            found += _needs(value[3])
        elif kind is op.BRANCH:
            each = [max(_needs(x), key=_strength, default=set()) for x in value[1]]
            if all(each):
                found.append(set().union(*each))
    return [*found, {run}] if run else found


def _strength(literals: set[str]) -> int:
    return min(map(len, literals))


def required_literals(pattern: str) -> list[str]:
    """Literals, A-Z in lower case, one of which occurs in the lower-cased text of every match; empty if none is known."""
    if _OTHER_DIALECT.search(pattern):
        return []
    try:
        best = max(_needs(parser.parse(pattern)), key=_strength, default={""})
    except (re.error, OverflowError, RecursionError):
        return []
    return sorted({_ascii_lower(x) for x in best}) if _strength(best) >= SHORTEST_LITERAL else []


def _candidates(literals: dict[str, list[int]]):
    """(repo_id, path, i, code, rule_no) for the lines that hold a literal of a rule, from (repo_id, path, text)."""
    names = ["repo_id", "path", "i", "code", "rule_no"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for text, rules in literals.items():
            automaton.add_word(text, rules)
        automaton.make_automaton()
        for batch in batches:
            for repo, path, text in zip(*batch.columns):
                text = text.as_py()
                if not text:
                    continue
                rows = []
                # lines end as in ``split_lines``; a literal may span none of them
                for i, line in enumerate(re.split(r"\r\n|\r|\n", text)):
                    hit = {r for _, rules in automaton.iter(_ascii_lower(line)) for r in rules}
                    rows += [(repo.as_py(), path.as_py(), i, line, r) for r in sorted(hit)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def screen_rules(files: DataFrame, rules: list[dict] | DataFrame | None = None) -> DataFrame:
    """``files(repo_id, path, text)`` -> findings ``(repo_id, file_path, rule_id, pipeline_id,
    vulnerability, severity, confidence_level, line_no, code_snippet, line)``.

    ``rules`` are dicts or rows with ``rule_id, pattern, pipeline_id, vulnerability, severity``; null patterns match nothing."""
    spark = files.sparkSession
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.length("pattern"))).first()[0] or 0
        if size > MAX_RULE_BYTES:
            raise ValueError(f"the rule table has {size} characters of patterns; at most {MAX_RULE_BYTES} are held by a task")
        rules = [r.asDict() for r in rules.select(*RULE_FIELDS, "pattern").collect()]
    rules = [r for r in (DEFAULT_RULES if rules is None else rules) if r["pattern"] is not None]
    texts = files.select("repo_id", "path", F.col("text").cast("string").alias("text"))
    literals: dict[str, list[int]] = {}
    plain: list[dict] = []
    for no, rule in enumerate(rules):
        needed = required_literals(rule["pattern"])
        for literal in needed:
            literals.setdefault(literal, []).append(no)
        if not needed:
            plain.append(rule)
    found = []
    if literals:
        table = spark.createDataFrame([(no, *(r[f] for f in RULE_FIELDS), r["pattern"]) for no, r in enumerate(rules)],
                                      "rule_no int, rule_id string, pipeline_id string, vulnerability string, severity string, pattern string")
        near = texts.select(F.col("repo_id").cast("string"), F.col("path").cast("string"), "text").mapInArrow(
            _candidates(literals), "repo_id string, path string, i int, code string, rule_no int")
        found.append(near.join(table, "rule_no").filter(F.expr("code RLIKE pattern")).select("repo_id", "path", "i", "code", *RULE_FIELDS))
    # *_outer + null filter: a plain explode makes the optimizer infer size(lines) > 0 and push
    # that (the whole split) below any repartition, into the scan task
    lines = texts.select("repo_id", "path", F.posexplode_outer(split_lines(F.col("text"))).alias("i", "code")) \
        .filter(F.col("i").isNotNull())
    for low in range(0, len(plain), RULES_AT_ONCE):
        hits = F.array(*[F.when(F.col("code").rlike(r["pattern"]), F.struct(*[F.lit(r[f]).alias(f) for f in RULE_FIELDS]))
                         for r in plain[low:low + RULES_AT_ONCE]])
        found.append(lines.select("repo_id", "path", "i", "code", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
                     .select("repo_id", "path", "i", "code", *[f"h.{f}" for f in RULE_FIELDS]))
    if not found:
        found.append(lines.filter(F.lit(False)).select("repo_id", "path", "i", "code", *[F.lit(None).cast("string").alias(f) for f in RULE_FIELDS]))
    matched = found[0]
    for more in found[1:]:
        matched = matched.unionByName(more)
    line_no = (F.col("i") + 1).cast("int")
    return matched.select(
        "repo_id", F.col("path").alias("file_path"), *RULE_FIELDS, F.lit("Low").alias("confidence_level"), line_no.alias("line_no"),
        F.col("code").alias("code_snippet"), F.array(line_no).alias("line"),
    )
