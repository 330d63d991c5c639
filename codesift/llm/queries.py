"""Registered queries of the training-data operators over the test tables, and their DuckDB twins.

Each query applies one operator, with production parameters, to its whole table and derives the
digest columns from the operator's real output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm import (
    block_search, chat, decontaminate, fill_middle, host_rules, line_dedup, ngram_join, packing, pii, rule_ensemble, sharding, suffix_dedup, whitening)
from codesift.session import scratch_path
from codesift.sources.corpus import read_table

N_SHARDS = 24
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


EXTRA_CONVERSATION = (
    '{"messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"}, '
    '{"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}')


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table as JSON turn rows, plus conversation -7 as a message list."""
    rows = read_table(spark, sf_dir, "conversations")
    turns = rows.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(EXTRA_CONVERSATION).alias("record"))
    return turns.unionByName(extra)


def q_schema_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = chat.format_turns(chat.canonical_turns(conversation_records(spark, sf_dir)))
    back = chat.read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL_SCHEMA_FINGERPRINT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), c AS (
  SELECT *, length(role) + length(text) + 23
    + len(regexp_extract_all(role, '[<\[]\\*(/?s>|</?SYS>>|/?INST\]|\|\w+\|>)'))
    + len(regexp_extract_all(text, '[<\[]\\*(/?s>|</?SYS>>|/?INST\]|\|\w+\|>)')) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def _held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def q_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(~_held_out(F.col("doc_id")))
    model = rule_ensemble.train(docs, labels)
    return rule_ensemble.score(docs, model).select(
        "doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def q_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_groups(read_table(spark, sf_dir, "documents"), n=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id")


SQL_PREFIX_TREE_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(list_slice(ws, i, i + 2), ' ')) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM c JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * k >= 90 * (nx.n + ny.n - k)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def q_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind_no"] < len(pii.BASE_KINDS))
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", *[F.size(F.array_remove(F.transform("spans", lambda x: F.when(x["kind"] == F.lit(kind), 1).otherwise(0)), 0))
                 .cast("long").alias(f"n_{kind}") for kind in [*pii.BASE_KINDS, "account", "secret"]],
        F.size(F.filter("spans", lambda x: x["kind"] != "url")).cast("long").alias("n_private"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def q_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.delete_repeats(read_table(spark, sf_dir, "documents"))
    return rows.select("doc.doc_id", "n_lines", "n_deleted",
                       F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("kept_sha256"))


#: Equal lines on one diagonal of (later document, earlier document) without a gap are a maximal common run.
SQL_LINE_RUNS = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents
), l AS (
  SELECT doc_id, generate_subscripts(all_lines, 1) AS pos, unnest(all_lines) AS line FROM d
), s AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS nth,
    len(list_filter(regexp_split_to_array(line, '[ \x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM l WHERE regexp_replace(line, '[ \x09-\x0D]', '', 'g') <> ''
), p AS (
  SELECT a.doc_id, b.doc_id AS first_id, a.nth, a.nth - b.nth AS diagonal, a.n
  FROM s a JOIN s b ON a.line = b.line AND (a.doc_id > b.doc_id OR a.doc_id = b.doc_id AND a.nth > b.nth)
), island AS (
  SELECT *, nth - row_number() OVER (PARTITION BY doc_id, first_id, diagonal ORDER BY nth) AS run FROM p
), long AS (
  SELECT doc_id, min(nth) AS low, max(nth) AS high FROM island GROUP BY doc_id, first_id, diagonal, run HAVING sum(n) >= 20
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS nth FROM (SELECT DISTINCT * FROM long)
), n AS (
  SELECT s.doc_id, count(*) AS n_lines, count(gone.nth) AS n_deleted FROM s LEFT JOIN gone USING (doc_id, nth) GROUP BY s.doc_id
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS t
  FROM l LEFT JOIN s ON l.doc_id = s.doc_id AND l.pos = s.pos
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = s.doc_id AND gone.nth = s.nth) GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def q_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def q_pigeonhole_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))



def q_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(read_table(spark, sf_dir, "documents"))


SQL_HOST_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, source, t,
    list_filter(regexp_split_to_array(t, '[ \x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[ \x09-\x0D]', '', 'g') <> '') AS ls
  FROM d
), base AS (
  SELECT doc_id, source, len(ws) AS n_words, length(regexp_replace(t, '[ \x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines
  FROM w
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), rep AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), gaps AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS c FROM rep
), r AS (
  SELECT doc_id, sum(c) AS n FROM gaps GROUP BY doc_id
), m AS (
  SELECT base.*, coalesce(r.n, 0) AS n_repeat_words FROM base LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    100 * n_symbols > 50 * n_words AS fail_symbols, 100 * n_dup_lines > 30 * n_lines AS fail_lines
  FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS a, count(*) FILTER (fail_symbols) AS b,
    count(*) FILTER (fail_lines) AS c FROM f GROUP BY source
), long AS (
  UNPIVOT h ON a, b, c INTO NAME rule VALUE k
), p AS (
  SELECT rule, sum(k) / sum(n) AS mean, var_pop(k / n) AS v, avg(1 / n) AS inv FROM long GROUP BY rule
), s AS (
  SELECT rule, mean, least(greatest(mean * (1 - mean) / greatest(v - mean * (1 - mean) * inv, 1e-6) - 1, 1), 1e4) AS strength
  FROM p
), bad AS (
  SELECT DISTINCT source FROM long JOIN s USING (rule) WHERE (k + mean * strength) / (n + strength) > 0.5
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source) AS kept
FROM f
"""


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


SQL_SUFFIX_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)
), f AS (
  SELECT k, min(doc_id) AS least FROM w GROUP BY k
), later AS (
  SELECT w.doc_id, w.i FROM w JOIN f USING (k) WHERE f.least < w.doc_id
), b AS (
  SELECT doc_id, substr(h, 2 * j + 1, 2) AS byte, j FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS j FROM d)
), c AS (
  SELECT b.*, coalesce(j - max(later.i) OVER (PARTITION BY b.doc_id ORDER BY j) < 50, false) AS gone
  FROM b LEFT JOIN later ON later.doc_id = b.doc_id AND later.i = b.j
), e AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS begins FROM c
), a AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
    string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""


def q_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = scratch_path(spark, f"slot-maps-{uuid.uuid4().hex}")
    placed, _ = sharding.assign(read_table(spark, sf_dir, "documents"), N_SHARDS, map_path=maps)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "vslot")


def q_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL_FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), e AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM e
), q AS (
  SELECT *, '<P>' || substr(t, 1, a) AS prefix, '<S>' || substr(t, b + 1) AS suffix, '<M>' || substr(t, a + 1, b - a) AS middle FROM p
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN prefix || suffix || middle ELSE suffix || prefix || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM q
"""


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


#: Rows whose id is divisible by this are queries of the vector search.
QUERY_STEP = 50


def q_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


SQL_BLOCK_SEARCH = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda x, y: x + y)) AS norm FROM v
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]),
    lambda x, y: x + y) / (q.norm * c.norm) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND (q.vec_id <> c.vec_id OR q.v <> c.v)
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


QUERIES = {
    "op1_schema_fingerprint": q_schema_fingerprint,
    "op2_rule_ensemble": q_rule_ensemble,
    "op3_prefix_tree_join": q_prefix_tree_join,
    "op4_anchor_expansion": q_anchor_expansion,
    "op5_line_runs": q_line_runs,
    "op6_harmonic_packing": q_harmonic_packing,
    "op7_host_rules": q_host_rules,
    "op8_suffix_dedup": q_suffix_dedup,
    "op9_virtual_slots": q_virtual_slots,
    "op10_pigeonhole_edits": q_pigeonhole_edits,
    "op11_fill_middle": q_fill_middle,
    "op12_whitening": q_whitening,
    "op13_block_search": q_block_search,
}

ORACLE_SQL = {
    "op1_schema_fingerprint": SQL_SCHEMA_FINGERPRINT,
    "op3_prefix_tree_join": SQL_PREFIX_TREE_JOIN,
    "op5_line_runs": SQL_LINE_RUNS,
    "op8_suffix_dedup": SQL_SUFFIX_DEDUP,
    "op7_host_rules": SQL_HOST_RULES,
    "op11_fill_middle": SQL_FILL_MIDDLE,
    "op13_block_search": SQL_BLOCK_SEARCH,
}
