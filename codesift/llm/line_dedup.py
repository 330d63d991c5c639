"""Line deduplication: later copies of repeated line runs are deleted.

The corpus is a sequence of line ids (64-bit line hashes; blank lines are skipped and stay), document by document in the
order of their ids.  A maximal repeated run is the longest common prefix of two suffixes of that sequence, inside one
document each, that cannot be extended to the left either.  The later copy of every maximal run of at least ``MIN_WORDS``
words is deleted; overlapping runs add up.

Method: prefix doubling.  Round k names every run of 2^k lines by the names of its halves.  The names are hashes, so
equal runs get equal names in any document without an exchange between rounds, and each
document's rounds are array expressions in its own row.  Two suffixes share a run of ``MIN_WORDS`` words or more if they agree on the
shortest prefix that has so many words, so doubling stops after ``LEVELS`` rounds and each suffix gets the name of exactly this
prefix, put together from the rounds: suffixes with equal names are one interval of the suffix array with that common prefix.
The same is done from right to left, for the shortest run that ends at each line.  Both together give every maximal run
whole: its beginning is the shortest prefix of the suffix where it begins, and each line behind that ends a shortest run that lies inside the
maximal run, so it has the same earlier copy.  One partially aggregated shuffle on the name finds each
interval's first place, and a join on the name (split by adaptive execution where one name is very frequent) marks the later ones.

Only DataFrame functions are used; the text itself is shuffled once, to meet the deletions.

Defined cases: a null text has no lines and stays null; rows equal in id and text are one document and keep
the same lines; a null id comes before all others; documents are ordered by id, then row hash; an empty table gives
an empty result; all columns of the input are passed through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.staging import settled, staged

MIN_WORDS = 20
#: Runs of up to 2^LEVELS - 1 lines: a line has a word, so ``MIN_WORDS`` words need at most as many lines.
LEVELS = MIN_WORDS.bit_length()
WORD = "[^ \\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def _solid(line: Column) -> Column:
    return F.translate(line, BLANKS, "") != ""


def _row_id(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _joined(array: str, distance: int, join: Callable) -> Callable[[Column, Column], Column]:
    """Element i joined with element i + distance; null where the array ends before."""
    def pair(x: Column, i: Column) -> Column:
        other = F.get(array, i + distance)
        return F.when(x.isNotNull() & other.isNotNull(), join(x, other))

    return pair


def _advance(names: str, words: str, size: int, step: int) -> Callable[[Column], Column]:
    """Move the end of a run over the next ``size`` lines, to the right (step 1) or left (-1), if it still has too few
    words after them."""
    def move(s: Column) -> Column:
        block = s["at"] if step > 0 else s["at"] - (size - 1)
        total = s["sum"] + F.get(words, block)
        moved = F.struct((s["at"] + step * size).alias("at"), total.alias("sum"),
                         F.xxhash64(s["name"], F.get(names, block)).alias("name"))
        return F.when(total < MIN_WORDS, moved).otherwise(s)

    return move


def _run(step: int) -> Callable[[Column, Column], Column]:
    """The finished run of a state: its first line, length and name."""
    def run(s: Column, i: Column) -> Column:
        last = F.get("name0", s["at"])
        start, lines = (i, s["at"] - i + 1) if step > 0 else (s["at"], i - s["at"] + 1)
        return F.struct(start.alias("start"), lines.alias("n_lines"),
                        F.when(last.isNotNull(), F.xxhash64(F.lit(step), s["name"], last, lines)).alias("name"))

    return run


def run_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_id, start, n_lines, name): the shortest run of ``MIN_WORDS`` words that begins at each line and the one
    that ends there; ``start`` counts the lines with a word from 0, and equal names are equal runs of one direction."""
    row = docs.select(F.col(id_col).alias("doc_id"), _row_id(id_col, text_col).alias("row_id"),
                      F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), _solid).alias("lines"))
    row = row.withColumn("name0", F.transform("lines", lambda x: F.xxhash64(x))) \
        .withColumn("words0", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD)))).drop("lines")
    for k in range(1, LEVELS):
        row = row.withColumn(f"name{k}", F.transform(f"name{k - 1}", _joined(f"name{k - 1}", 1 << k - 1, F.xxhash64))) \
            .withColumn(f"words{k}", F.transform(f"words{k - 1}", _joined(f"words{k - 1}", 1 << k - 1, lambda x, y: x + y)))
    state = F.transform("name0", lambda x, i: F.struct(i.alias("at"), F.lit(0).alias("sum"), F.lit(0).cast("long").alias("name")))
    row = row.withColumn("right", state).withColumn("left", state)
    for k in reversed(range(LEVELS)):
        for side, step in (("right", 1), ("left", -1)):
            row = row.withColumn(side, F.transform(side, _advance(f"name{k}", f"words{k}", 1 << k, step)))
    runs = F.concat(F.transform("right", _run(1)), F.transform("left", _run(-1)))
    return row.select("doc_id", "row_id", F.explode(F.filter(runs, lambda x: x["name"].isNotNull())).alias("s")) \
        .select("doc_id", "row_id", "s.*")


def later_runs(names: DataFrame) -> DataFrame:
    """The runs that also begin at an earlier place, with that first place (first_doc_id, first_start)."""
    place = F.struct("doc_id", "row_id", "start")
    first = names.groupBy("name").agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .filter(F.col("first") != F.col("last")).select("name", "first")
    return names.join(first, "name").filter(place > F.col("first")).select(
        "doc_id", "row_id", "start", "n_lines",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_id, start, n_lines): the maximal runs of neighbouring lines that are deleted."""
    later = later_runs(staged(run_names(docs, id_col, text_col), "line-runs")).distinct()
    order = Window.partitionBy("row_id").orderBy("start")
    reach = F.max(F.col("start") + F.col("n_lines")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("fresh", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    numbered = marked.withColumn("run", F.sum("fresh").over(order))
    return numbered.groupBy("doc_id", "row_id", "run").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("n_lines")) - F.min("start")).alias("n_lines")).drop("run")


def delete_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n_lines, n_deleted): the input rows as a struct with their text rewritten, the number
    of lines with a word, and how many of them were deleted."""
    later = later_runs(staged(run_names(docs, id_col, text_col), "line-runs"))
    gone = later.groupBy(F.col("row_id").alias("gone_id")).agg(F.collect_set(F.struct("start", "n_lines")).alias("runs"))
    rows = docs.select(F.struct("*").alias("doc"), _row_id(id_col, text_col).alias("row_id"), F.col(text_col).alias("text"))
    row = rows.join(gone, F.col("row_id") == F.col("gone_id"), "left").drop("gone_id", "row_id")
    row = row.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    row = row.withColumn("solid", F.filter(every, lambda i: _solid(F.get("lines", i))))
    row = row.withColumn("deleted", F.coalesce(F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["start"], r["start"] + r["n_lines"] - 1)))), F.array().cast("array<int>")))
    keep = F.array_except(every, F.transform("deleted", lambda o: F.get("solid", o)))
    text = F.when(F.size("deleted") > 0, F.array_join(F.transform(keep, lambda i: F.get("lines", i)), "\n")).otherwise(F.col("text"))
    return row.select(F.col("doc").withField(f"`{text_col}`", text).alias("doc"),
                      F.size("solid").cast("long").alias("n_lines"), F.size("deleted").cast("long").alias("n_deleted"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the deleted lines; a document that loses all its lines goes."""
    rows = settled(delete_repeats(docs, id_col, text_col), "doc", "n_lines", "n_deleted")
    return rows.filter((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines"))).select("doc.*")
