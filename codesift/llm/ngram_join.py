"""Exact n-gram Jaccard join over a forest of prefix trees.

A document's set is its distinct word n-grams as 64-bit names, ordered by name everywhere.  Two
documents link when 100 * intersection >= percent * union.

1. *Classes.*  Equal sets are one class; only one member of a class is compared.
2. *Forest.*  The order of names is cut into k ranges, k by the sets' size so that linked sets agree wholly on
   at least one range (they differ in fewer names than there are ranges).  The names of a set
   inside one range are one branch, and sets that share a branch meet there.
3. *Trees.*  Sets of a branch are stored in a prefix tree in the global order and a probe walks
   it: overlaps of shared beginnings are counted once, and a subtree is pruned when the remaining
   lengths cannot reach the overlap needed (``prefix_tree``).
4. *Few probes per branch.*  First every set of a branch is compared with the branch's hub only, the set that
   meets most others on all its branches (in a family of near copies, their common original).  Sets
   that are connected by then need no comparison with each other; in branches that still hold several components,
   sets outside the largest one are compared with the sets of other components, once per pair,
   and only if they share as many branches as linked sets must and their bitmaps differ in no
   more bits than linked sets can.  Each set is compared on its rarer branches, and a branch that is still large is cut into
   blocks that meet pairwise in separate tasks.  So a family costs comparisons in proportion to
   its size, and no link between components is lost.

Branches are streams sorted by name; a probe meets its candidates in blocks of at most ``BLOCK``, and a
probe with many candidates is salted over tasks.  Names of texts are recomputed, never collected.

Defined cases: a null, empty or blank text has an empty set, linked with nothing, and is its own
component; fewer words than n make one n-gram; null ids take part, and a component's id is its smallest non-null
one; rows with equal ids are joined separately; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.components import components
from codesift.llm.prefix_tree import PrefixTree
from codesift.llm.staging import staged

#: Ranges beyond the number that the pigeonhole needs: so many, and one more per SPARE_SHARE of that number,
#: which exceeds the ranges that a set leaves empty by chance.  A set emits empty ranges only if it has more of them.
SPARE, SPARE_SHARE = 4, 12
#: Bits of a set's bitmap.  Two sets differ in at least as many names as their bitmaps differ in bits.
BITS = 2048
#: Candidates of a probe per tree.
BLOCK = 256
#: Sets of an open branch that meet in one task at least; a large branch has larger blocks, 16 times the root of its size.
OPEN_BLOCK = 1024

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE, np.uint64)])
        return self.up, self.down


def ngram_set(text: str | None, n: int, powers: _Powers) -> np.ndarray:
    """The ordered distinct names of the word n-grams (A-Z lower-cased, words between ASCII blanks)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    up, down = powers.reach(len(joined) + 1)
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_CODE[joined] * up[:len(joined)], out=total[1:])
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    span = min(n, len(words))
    first, last = starts[:len(words) - span + 1], ends[span - 1:]
    return np.unique(_mix((total[last] - total[first]) * down[first]))


def class_of(names: np.ndarray) -> int:
    """One signed 64-bit id per set."""
    mixed = _mix(names * np.uint64(_BASE) + np.uint64(len(names)))
    with np.errstate(over="ignore"):
        return int(_mix(np.array([mixed.sum(dtype=np.uint64)], np.uint64))[0].view(np.int64))


def bitmap(names: np.ndarray) -> bytes:
    """One bit per name, by the name's lowest bits."""
    bits = np.zeros(BITS, np.uint8)
    bits[names & np.uint64(BITS - 1)] = 1
    return np.packbits(bits).tobytes()


class Ranges:
    """Size classes and the number of ranges in each, for one similarity."""

    def __init__(self, percent: int):
        self.percent = percent
        self.begin = [1]  # smallest set size of each class
        self._cuts: dict[int, np.ndarray] = {}

    def _size_class(self, size: int) -> int:
        while self.begin[-1] <= size:
            b = self.begin[-1]
            self.begin.append(max(b + 1, (b - 1) * 100 // self.percent + 1))
        lo, hi = 0, len(self.begin) - 1
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.begin[mid] <= size else (lo, mid)
        return lo

    def _branches_in(self, space: int, names: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, int]:
        # linked sets, the smaller one in this class, differ in at most this many names
        differ = (self.begin[space + 1] - 1) * (100 - self.percent) // self.percent
        if differ == 0:
            return np.empty(0, np.uint64), 0
        spare = SPARE + differ // SPARE_SHARE
        k = differ + 1 + spare
        if k not in self._cuts:
            self._cuts[k] = np.array([-(-i * (1 << 64) // k) for i in range(1, k)], np.uint64)
        at = np.r_[0, np.searchsorted(names, self._cuts[k]), len(names)]
        inside = sums[at[1:]] - sums[at[:-1]]
        branch = _mix(inside + _mix(np.arange(k, dtype=np.uint64) + np.uint64(space << 32)))
        empty = at[1:] == at[:-1]
        n_empty = int(empty.sum())
        # of the spare + 1 ranges on which linked sets agree at least, those empty in both are no common branch
        return (branch, 1) if n_empty > spare else (branch[~empty], spare + 1 - n_empty)

    def branches(self, names: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(space, kind, branch names): in the set's own size class and, as the larger set, in the one below.

        Two sets of a space can be linked only if one of them has the space as its own class, and then
        share at least as many branches there as either of them demands; kind is twice this demand, plus one in
        the own class.
        """
        own = self._size_class(len(names))
        sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(_mix(names), out=sums[1:])
        out = []
        for space in (own, own - 1):
            if space >= 0:
                found, need = self._branches_in(space, names, sums)
                if len(found):
                    out.append((space, 2 * need + (space == own), found))
        return out


BRANCHES = "branch bigint, class bigint, space int, kind int"
BRANCH_COLUMNS = ["branch", "class", "space", "kind"]


def _arrow(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_id, doc_id, text): rows are told apart by id and text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("row_id"), "doc_id", "text")


def document_sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(row_id, doc_id, n_shingles, class, bits) per row; the class of an empty set is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            sets = [ngram_set(t.as_py(), n, powers) for t in batch.column(2)]
            yield _arrow(["row_id", "doc_id", "n_shingles", "class", "bits"], [
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())])

    return _keyed(docs, id_col, text_col).mapInArrow(
        run, "row_id bigint, doc_id bigint, n_shingles bigint, class bigint, bits binary")


def _branch_rows(docs: DataFrame, n: int, percent: int, text_col: str) -> DataFrame:
    """(branch, class, space, kind): each class of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, ranges = _Powers(), Ranges(percent)
        for batch in batches:
            seen: set[int] = set()
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for text in batch.column(0):
                names = ngram_set(text.as_py(), n, powers)
                if not len(names) or (own := class_of(names)) in seen:
                    continue
                seen.add(own)
                for space, kind, found in ranges.branches(names):
                    columns[0].append(found.view(np.int64))
                    columns[1].append(np.full(len(found), own, np.int64))
                    columns[2].append(np.full(len(found), space, np.int32))
                    columns[3].append(np.full(len(found), kind, np.int32))
            if columns[0]:
                yield _arrow(BRANCH_COLUMNS, [pa.array(np.concatenate(c)) for c in columns])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, BRANCHES)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of branches with several classes, each (branch, class) once, from a stream sorted by
    both.  Between batches only the last row is kept."""
    held, given = None, False
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(rows[0]):
            continue
        mine = np.ones(len(rows[0]), bool)
        if held is not None:
            rows = [np.r_[h, c] for h, c in zip(held, rows)]
            mine = np.r_[not given, mine]
        branch, own = rows[0], rows[1]
        fresh = np.r_[True, (branch[1:] != branch[:-1]) | (own[1:] != own[:-1])]
        rows, mine = [c[fresh] for c in rows], mine[fresh]
        starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        sizes = np.diff(np.r_[starts, len(rows[0])])
        several = sizes > 1
        several[0] |= given
        out = np.repeat(several, sizes) & mine
        held, given = [c[-1] for c in rows], bool(several[-1])
        if out.any():
            yield _arrow(BRANCH_COLUMNS, [pa.array(c[out]) for c in rows])


def _class_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(class, names) for the wanted classes, the names as bytes, from one document of each class."""
    chosen = sets.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("row_id").alias("row_id")) \
        .join(wanted, "class")
    found = _keyed(docs, id_col, text_col).join(chosen, "row_id").select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            rows = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                names = ngram_set(text.as_py(), n, powers)
                if len(names) and class_of(names) == own:  # a row id is a hash
                    rows.append((own, names.tobytes()))
            if rows:
                yield _arrow(["class", "names"], [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary()))])

    return found.mapInArrow(run, "class bigint, names binary").groupBy("class").agg(F.first("names").alias("names"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among (hub, class) pairs.  Candidates of a hub come in blocks; each block is one prefix tree
    that the hub's set probes."""
    counted = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    probes = counted.join(sets, counted["hub"] == sets["class"]).select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("bigint").alias("class"), "names")
    members = pairs.join(counted, "hub").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")) \
        .join(sets, "class").select("hub", "block", "class", "names")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probe, held = None, None, []

        def flush() -> list[tuple[int, int]]:
            if probe is None or not held:
                return []
            tree = PrefixTree([s for _, s in held])
            return [(key[0], held[i][0]) for i in tree.similar(probe, percent)]

        for batch in batches:
            out = []
            for hub, block, own, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (hub, block) != key or len(held) >= BLOCK:
                    out += flush()
                    held = []
                if (hub, block) != key:
                    key, probe = (hub, block), None
                names = np.frombuffer(raw, np.uint64)
                if own is None:
                    probe = names
                else:
                    held.append((own, names))
            if out:
                yield _arrow(["a", "b"], [pa.array(c, pa.int64()) for c in zip(*out)])
        if out := flush():
            yield _arrow(["a", "b"], [pa.array(c, pa.int64()) for c in zip(*out)])

    rows = probes.unionByName(members).repartition("hub", "block").sortWithinPartitions("hub", "block", F.col("class").asc_nulls_first())
    return rows.mapInArrow(run, "a bigint, b bigint")


OPEN = ("branch bigint, probes int, members int, role int, class bigint, root bigint, inside boolean, kind int, "
        "all array<bigint>, n_shingles bigint, bits binary")


def open_cells(left: DataFrame, sets: DataFrame) -> DataFrame:
    """The comparisons that open branches still need (see ``OPEN``), from (branch, class, root, space, kind).

    Rare branches first: ``all`` are a class's branches by their size, smallest first, an order in which all classes agree.
    Linked sets share ``need`` branches, so the first one they share is not among the last ``need - 1`` of either; a class
    is compared on the others only.  What is left of a branch becomes cells: blocks of the sets outside its largest
    component (role 0) against blocks of all its sets (role 1), so no task holds a whole branch.
    """
    by_root = left.groupBy("branch", "root").agg(F.count(F.lit(1)).alias("n"))
    about = by_root.groupBy("branch").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("top"))
    block = F.greatest(F.lit(OPEN_BLOCK), F.ceil(16 * F.sqrt("size")))
    about = about.select(
        "branch", F.col("top.root").alias("most"), F.ceil(F.col("size") / block).cast("int").alias("member_blocks"),
        F.ceil((F.col("size") - F.col("top.n")) / block).cast("int").alias("probe_blocks"),
        "size")
    ranked = left.join(about, "branch")
    lists = ranked.groupBy("class", "space").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("size", "branch"))), lambda x: x["branch"]).alias("all"))
    shapes = sets.join(left.select("class").distinct(), "class", "left_semi").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"))
    need = F.shiftright("kind", 1)
    rows = ranked.join(lists, ["class", "space"]) \
        .filter(F.array_position("all", F.col("branch")) <= F.size("all") - need + 1) \
        .join(shapes, "class").withColumn("inside", F.col("root") == F.col("most"))

    def role(rows: DataFrame, no: int, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("class"), F.col(f"{own}_blocks")).cast("int")
        rows = rows.filter(f"{own}_blocks > 0 AND {other}_blocks > 0") \
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).withColumn("_own", mine)
        probes, members = ("_own", "_other") if no == 0 else ("_other", "_own")
        return rows.select("branch", F.col(probes).alias("probes"), F.col(members).alias("members"), F.lit(no).alias("role"),
                           "class", "root", "inside", "kind", "all", "n_shingles", "bits")

    return role(rows.filter(~F.col("inside")), 0, "probe", "member").unionByName(role(rows, 1, "member", "probe"))


class _OpenSets:
    """Some rows of a cell as arrays."""

    def __init__(self, rows: pa.RecordBatch):
        self.own, self.root, self.inside, self.kind, self.sizes = (
            rows.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6, 7, 9))
        self.every = rows.column(8).flatten().to_numpy(zero_copy_only=False)
        self.begins = np.r_[0, np.cumsum(pc.list_value_length(rows.column(8)).to_numpy())]
        self.bits = np.frombuffer(b"".join(rows.column(10).to_pylist()), np.uint64).reshape(len(self.own), -1)
        self.need, self.base = self.kind >> 1, (self.kind & 1) == 1


def _open_pairs(percent: int):
    """(hub, class) pairs still to be compared, from a stream of cells (see ``open_cells``), probes first.

    A probe is paired with the sets of other components that it may be linked to: their bitmaps differ in no more bits than
    linked sets can, and they share as many branches as either demands.  A pair is given out on the
    first of its common branches only, and two sets outside the largest component once.
    """

    def pairs(branch: int, held: list[_OpenSets], rows: _OpenSets) -> Iterator[pa.RecordBatch]:
        for p in held:
            for i in range(len(p.own)):
                may = (rows.root != p.root[i]) & (rows.inside | (rows.own > p.own[i])) & (rows.base | p.base[i])
                if not may.any():
                    continue
                may = np.flatnonzero(may)
                differ = np.bitwise_count(rows.bits[may] ^ p.bits[i]).sum(axis=1, dtype=np.int64)
                may = may[(100 + percent) * differ <= (100 - percent) * (rows.sizes[may] + p.sizes[i])]
                mine, found = p.every[p.begins[i]:p.begins[i + 1]], []
                for j in may.tolist():
                    common = mine[np.isin(mine, rows.every[rows.begins[j]:rows.begins[j + 1]])]
                    if len(common) >= max(rows.need[j], p.need[i]) and common[0] == branch:
                        found.append(rows.own[j])
                if found:
                    yield _arrow(["hub", "class"], [pa.array(np.full(len(found), p.own[i])), pa.array(found, pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
            cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
                key = tuple(keys[:3, low].tolist())
                if key != cell:
                    cell, held = key, []
                part = _OpenSets(batch.slice(low, high - low)) if held or keys[3, low] == 0 else None
                if keys[3, low] == 0:
                    held.append(part)
                elif held:
                    yield from pairs(key[0], held, part)

    return run


def links_and_components(docs: DataFrame, sets: DataFrame, n: int, percent: int,
                         id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(links between classes, (node, root) of the classes that have links)."""
    branches = _branch_rows(docs, n, percent, text_col).repartition("branch").sortWithinPartitions("branch", "class")
    met = staged(branches.mapInArrow(_meetings, BRANCHES), "branches")
    met_size = met.groupBy("branch").agg(F.count(F.lit(1)).alias("size"))
    degree = met.join(met_size, "branch").groupBy("class").agg(F.sum(F.col("size") - 1).alias("degree"))
    degree = staged(degree, "degrees")
    hubs = met.join(degree, "class").groupBy("branch").agg(F.max(F.struct("degree", "class"))["class"].alias("hub"))
    meet = met.join(hubs, "branch").filter("class <> hub").groupBy("hub", "class", "space").agg(
        F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind"))
    # a class that meets a hub on fewer branches than it demands waits for the open branches
    star = staged(meet.filter(2 * F.col("n") >= F.col("kind") - 1).select("hub", "class").distinct(), "star-pairs")
    links = staged(_compared(docs, sets, star, n, percent, id_col, text_col), "star-links")
    roots = components(links)

    placed = met.join(roots.withColumnRenamed("node", "class"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))
    still = placed.groupBy("branch").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("branch")
    left = staged(placed.join(still, "branch").select("branch", "class", "root", "space", "kind"), "open-branches")
    cell = ["branch", "probes", "members"]
    pairs = open_cells(left, sets).repartition(*cell).sortWithinPartitions(*cell, "role") \
        .mapInArrow(_open_pairs(percent), "hub bigint, class bigint")
    compared = star.unionByName(star.select(F.col("class").alias("hub"), F.col("hub").alias("class")))
    pairs = staged(pairs.join(compared, ["hub", "class"], "left_anti"), "open-pairs")
    if pairs.isEmpty():
        return links, roots
    more = staged(_compared(docs, sets, pairs, n, percent, id_col, text_col), "open-links")
    links = links.unionByName(more)
    return links, roots if more.isEmpty() else components(links)


def _compared(docs: DataFrame, sets: DataFrame, pairs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The links among (hub, class) pairs; only the sets of their classes are rebuilt from texts."""
    wanted = pairs.select("class").unionByName(pairs.select(F.col("hub").alias("class"))).distinct()
    return _verified(pairs, staged(_class_sets(docs, sets, wanted, n, id_col, text_col), "class-sets"), percent)


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, doc_id, n_shingles, class, component_id) per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the row's own included; ``class`` is
    the id of the row's set (null for an empty one).
    """
    sets = staged(document_sets(docs, n, id_col, text_col), "document-sets")
    _, roots = links_and_components(docs, sets, n, percent, id_col, text_col)
    least = sets.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    by_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.join(by_root, "root").select(F.col("class").alias("_class"), "component_id"), "components")
    return sets.join(named, F.col("class") == F.col("_class"), "left").select(
        "row_id", "doc_id", "n_shingles", "class", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_per_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest id; rows with empty sets stay, and of
    rows equal in id and text one."""
    groups = staged(similar_groups(docs, n, percent, id_col, text_col).filter(F.col("class").isNotNull()), "groups")
    # groups are told apart by their smallest id and, where no member has an id, by their class
    key = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("class")).alias("own")]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")
    first = groups.groupBy(*key).agg(F.min(order)["row_id"].alias("first"))
    dropped = groups.select("row_id").distinct().join(first.select(F.col("first").alias("row_id")), "row_id", "left_anti")
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col)).alias("row_id"))
    left = rows.join(dropped, "row_id", "left_anti")
    return left.groupBy("row_id").agg(F.first("doc").alias("doc")).select("doc.*")
