"""Chat formatting by schema fingerprints.

Records are JSON objects in whatever layout their source used (flat turn rows, message lists,
from/value lists, prompt/completion pairs, instruction triples).  The nested field paths of a record, without
its values and scalar types, are hashed; the hash selects a declarative mapping that turns the record into
canonical turns (pos, role, text).  Turns are then written in one template, with a span table that
says which characters belong to the loss.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``.  A control string inside a role or a text
(any ``<|name|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) gets one backslash
after its first character; one that already has backslashes there gets one more, so the escape is undone
exactly by removing one.

Only DataFrame functions are used.  Records stay one row each until the turns of a conversation are
joined to its text, which needs them together: a conversation is one output row by definition, and is
bounded by the 2 GB limit of a Spark string.

Spark's variant parser gives null for a string of more than 20,000,000 characters and for a variant above its size
limit.  The variant of a record of more than ``LONG`` bytes is therefore parsed with its strings above ``KEPT``
characters blanked, which leaves paths and short values as they are, and blanked fields are read by ``from_json``, whose
string limit is lifted.  A record that is above ``TOO_LARGE`` even then ends the run with an error.

Defined cases: null role or text is empty; records whose fingerprint has no mapping, or that are no JSON
objects, are returned by ``unmapped`` and give no turn; turns with equal positions are ordered by role,
then text; null ids form one conversation; repeated rows are repeated turns; an empty table gives an
empty result; extra columns are ignored, extra fields of a record change its fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.staging import settled

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_REST = r"(?=/?s>|</?SYS>>|/?INST\]|\|\w+\|>)"
_TURN_TYPE = "array<struct<pos bigint, role string, text string>>"
LOSS_ROLE = "assistant"
#: Bytes of a record up to which the variant parser takes any of its strings.
LONG = 16_000_000
#: Characters of the longest string that stays in the variant of a long record.
KEPT = 64
#: Bytes of a blanked record that the variant parser may refuse for its size.
TOO_LARGE = 64_000_000
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, r"$1$2")


def _is_long(record: Column) -> Column:
    return F.octet_length(record) > LONG


def _blanked(record: Column) -> Column:
    """A JSON text with its strings above ``KEPT`` characters emptied, but not its field names.

    Escaped backslashes and quotes and the two ends of a string are first made single control characters, which
    a JSON text cannot hold, so that no pattern needs to look behind an escape.
    """
    plain = F.replace(F.replace(record, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    ends = F.regexp_replace(plain, '"([^"]*+)"', "\x03$1\x04")
    blank = F.regexp_replace(ends, f"\x03[^\x04]{{{KEPT + 1},}}+\x04(?![ \\t\\r\\n]*+:)", "\x03\x04")
    small = blank
    for mark, shown in (("\x03", '"'), ("\x04", '"'), ("\x02", '\\"'), ("\x01", "\\\\")):
        small = F.replace(small, F.lit(mark), F.lit(shown))
    return F.when(F.octet_length(small) > TOO_LARGE, F.raise_error(F.lit(
        "a chat record is too large for Spark's variant parser"))).otherwise(small)


def _is_json(record: Column) -> Column:
    """Whether a long record parses, its blanked strings included."""
    read = F.from_json(record, "_bad string", {**_ANY_LENGTH, "columnNameOfCorruptRecord": "_bad"})
    return ~record.rlike("[\x01-\x04]") & read["_bad"].isNull()


def _variant(record: Column) -> Column:
    return F.try_parse_json(F.when(~_is_long(record), record).when(_is_json(record), _blanked(record)))


def structure(record: Column) -> Column:
    """The nested field paths of a variant as one string: names and nesting, scalar types erased."""
    return F.regexp_replace(F.schema_of_variant(record), r"(?<=[ <]|^)[A-Z][A-Z_]*(\([0-9, ]*\))?(?=[,>]|$)", "_")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(structure(record))


@dataclass(frozen=True)
class Mapping:
    """A layout: an example record that shows its fields, and how its fields become turns.

    ``turns`` gets the variant; ``_field`` and ``_listed`` also read what is blanked there from the column ``record``."""

    name: str
    example: str
    turns: Callable[[Column], Column]


def _turn(pos: Column, role: Column, text: Column) -> Column:
    return F.struct(pos.cast("long").alias("pos"), role.alias("role"), text.alias("text"))


def _whole(short: Column, native: Column) -> Column:
    """A string of the variant, or the string itself where a long record's variant has it blanked."""
    return F.when(_is_long(F.col("record")) & (short == ""), native).otherwise(short)


def _native(name: str, kind: str) -> Column:
    return F.from_json(F.col("record"), f"`{name}` {kind}", _ANY_LENGTH)[name]


def _field(record: Column, name: str, kind: str = "string") -> Column:
    value = F.try_variant_get(record, f"$.{name}", kind)
    return _whole(value, _native(name, kind)) if kind == "string" else value


def _listed(field: str, role: str, text: str, names: dict[str, str] | None = None) -> Callable[[Column], Column]:
    kind = f"array<struct<`{role}`: string, `{text}`: string>>"

    def turns(record: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            who = m[role]
            for source, canonical in (names or {}).items():
                who = F.when(m[role] == source, canonical).otherwise(who)
            return _turn(i, who, m[text])

        # the strings are made whole before the turns, so that a long list is read natively once
        short = _field(record, field, kind)
        whole = F.zip_with(short, _native(field, kind), lambda m, n: F.struct(
            _whole(m[role], n[role]).alias(role), _whole(m[text], n[text]).alias(text)))
        return F.transform(F.when(_is_long(F.col("record")), whole).otherwise(short), one)

    return turns


def _pair(user: Callable[[Column], Column], answer: str) -> Callable[[Column], Column]:
    return lambda r: F.array(_turn(F.lit(0), F.lit("user"), user(r)),
                             _turn(F.lit(1), F.lit(LOSS_ROLE), _field(r, answer)))


def _with_input(record: Column) -> Column:
    given = F.coalesce(_field(record, "input"), F.lit(""))
    return F.concat(_field(record, "instruction"), F.when(given != "", F.concat(F.lit("\n\n"), given)).otherwise(""))


MAPPINGS = [
    Mapping("turn row", '{"turn": 0, "role": "", "text": ""}',
            lambda r: F.array(_turn(_field(r, "turn", "bigint"), _field(r, "role"), _field(r, "text")))),
    Mapping("messages", '{"messages": [{"role": "", "content": ""}]}', _listed("messages", "role", "content")),
    Mapping("from/value", '{"conversations": [{"from": "", "value": ""}]}',
            _listed("conversations", "from", "value", {"human": "user", "gpt": LOSS_ROLE})),
    Mapping("prompt/completion", '{"prompt": "", "completion": ""}', _pair(lambda r: _field(r, "prompt"), "completion")),
    Mapping("instruction", '{"instruction": "", "output": ""}', _pair(lambda r: _field(r, "instruction"), "output")),
    Mapping("instruction with input", '{"instruction": "", "input": "", "output": ""}', _pair(_with_input, "output")),
]


def _parsed(records: DataFrame, id_col: str, record_col: str, mappings: list[Mapping]) -> DataFrame:
    rows = records.select(F.col(id_col).alias("conv_id"), F.col(record_col).alias("record"),
                          _variant(F.col(record_col)).alias("v"))
    rows = settled(rows.withColumn("fingerprint", fingerprint(F.col("v"))), "v", "fingerprint")
    layout = F.lit(None).cast("string")
    for m in mappings:
        layout = F.when(F.col("fingerprint") == fingerprint(F.parse_json(F.lit(m.example))), m.name).otherwise(layout)
    return rows.withColumn("layout", layout)


def canonical_turns(records: DataFrame, id_col: str = "conv_id", record_col: str = "record",
                    mappings: list[Mapping] | None = None) -> DataFrame:
    """(conv_id, layout, pos, role, text): one row per turn of every mapped record."""
    mappings = MAPPINGS if mappings is None else mappings
    turns = F.lit(None).cast(_TURN_TYPE)
    for m in mappings:
        turns = F.when(F.col("layout") == m.name, m.turns(F.col("v"))).otherwise(turns)
    rows = _parsed(records, id_col, record_col, mappings).filter(F.col("layout").isNotNull())
    return rows.select("conv_id", "layout", F.explode(turns).alias("t")).select("conv_id", "layout", "t.*")


def unmapped(records: DataFrame, id_col: str = "conv_id", record_col: str = "record",
             mappings: list[Mapping] | None = None) -> DataFrame:
    """(conv_id, record, fingerprint) of the records that no mapping fits."""
    rows = _parsed(records, id_col, record_col, MAPPINGS if mappings is None else mappings)
    return rows.filter(F.col("layout").isNull()).select("conv_id", "record", "fingerprint")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans): the text of each conversation and, per turn, where the turn and its
    text begin and end in code points and whether that text counts for the loss."""
    row = turns.select("conv_id", F.coalesce("pos", F.lit(-1)).alias("pos"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    row = row.withColumn("head", head).withColumn("body", escape(F.col("text")))
    row = row.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("pos", "role", "text")
    row = row.withColumn("n", F.row_number().over(order)).withColumn("start", F.coalesce(F.sum(
        F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    begin = F.col("start") + F.length("head")
    span = F.struct(F.col("start"), begin.alias("text_start"), (begin + F.length("body")).alias("text_end"),
                    (F.col("role") == LOSS_ROLE).alias("in_loss"))
    gathered = row.select("conv_id", F.struct("n", "piece", span.alias("span")).alias("x")).groupBy("conv_id") \
        .agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return gathered.select("conv_id", F.array_join(F.col("xs.piece"), "").alias("formatted"),
                           F.col("xs.span").alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts) parsed from the formatted text and its spans alone."""
    pieces = F.filter(F.split("formatted", r"<\|turn\|>"), lambda x, i: i > 0)
    row = formatted.withColumn("pieces", pieces)

    def turn(piece: Column) -> Column:
        parts = F.split(piece, r"<\|text\|>", 2)
        body = F.get(parts, F.lit(1))
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"),
                        unescape(F.left(body, F.length(body) - F.lit(len(END)))).alias("text"))

    def masked(piece: Column, i: Column) -> Column:
        span = F.get("spans", i)
        inside = (span["text_start"] - span["start"] - F.lit(len(TURN)) + 1).cast("int")
        text = F.substring(piece, inside, (span["text_end"] - span["text_start"]).cast("int"))
        return F.when(span["in_loss"], unescape(text))

    return row.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"),
                      F.filter(F.transform("pieces", masked), lambda x: x.isNotNull()).alias("loss_texts"))
