"""Nearest neighbours by cosine: a block matrix join with int8 tiles and exact recomputation.

A query set is searched against all rows of the table.

1. *Classes.*  Rows with equal vectors are equally near to everything, so candidates are grouped by vector and a class keeps
   its ``k + 1`` smallest ids, trimmed before the shuffle; more of them can never be among the ``k`` nearest.  Equal query
   vectors are searched once.  A vector that a third of all rows hold is one class.
2. *Blocks.*  Query classes and candidate classes are dealt to stripes; a cell of the grid is one query stripe against one
   candidate stripe.  A query goes to each candidate stripe and a candidate to each query stripe, once, so a cell costs the
   sum of its sides in shuffle and their product in arithmetic.  A task holds its query stripe (bounded by
   ``STRIPE_BYTES``) and reads candidates as a stream.
3. *Tiles.*  Unit vectors u are coded as int8 with one scale, u = s q + e, and tiles of code products give every cosine to within
   |e_u| + |s q_u| |e_w|.  A pair survives if its upper bound reaches the best known ``k + 1``-th lower
   bound of its query; the bounds hold for every pair, so no neighbour is lost.
4. *Heaps.*  Survivors are recomputed in double precision from the original vectors (entry after entry, so equal pairs
   give equal scores wherever they are computed) and each cell keeps ``k + 1`` of them per query; heaps merge the cells.

Defined cases: vectors that are null, empty, all zero, of another than the usual width or that hold null or non-finite entries take no part;
rows equal in id and vector are one row; a query does not find its own row (same id and vector); ties go to the smaller id, null
ids come last and are never queries by ``every``; with fewer candidates all are returned; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesift.llm.staging import staged
from codesift.llm.vectors import usable

NEAREST = 5
#: Bytes of query vectors, as doubles, that a task holds.
STRIPE_BYTES = 16 << 20
#: Candidate classes of a cell; fewer where there would be too few cells for all cores.
STRIPE_ROWS = 131_072
LEAST_ROWS = 2_048
TILE_QUERIES, TILE_CANDIDATES = 512, 2_048
#: Dimensions whose products of codes add up exactly in single precision: 1024 * 127^2 < 2^24.
PANEL = 1_024
#: Survivors recomputed at a time, in entries.
PAIR_ENTRIES = 1 << 20
#: More than the rounding of the bounds themselves.
SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max
SALTS = 16

CELLS = "qid bigint, scores array<double>, ids array<bigint>, own array<boolean>"
MERGED = "qid bigint, found array<struct<score: double, vec_id: bigint, own: boolean>>"


def _in_order(products: np.ndarray) -> np.ndarray:
    """Row sums, entry after entry."""
    return np.add.accumulate(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


class Coded:
    """Vectors with their int8 codes and error bounds."""

    def __init__(self, vectors: np.ndarray):
        largest = np.abs(vectors).max(axis=1)
        # an exact power of two, so that squares stay in range and cosines keep every bit
        self.vectors = np.ldexp(vectors, -np.frexp(largest)[1][:, None])
        self.norms = np.sqrt(_in_order(self.vectors ** 2))
        unit = self.vectors / self.norms[:, None]
        self.scales = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.scales[:, None])
        coded = codes * self.scales[:, None]
        self.codes = codes.astype(np.int8)
        self.errors = np.sqrt(((unit - coded) ** 2).sum(axis=1))
        self.lengths = np.sqrt((coded ** 2).sum(axis=1))


def tile_bounds(queries: Coded, rows: slice, candidates: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the cosines of some queries with all candidates."""
    total = 0.0
    for low in range(0, queries.codes.shape[1], PANEL):
        part = slice(low, low + PANEL)
        # single precision holds these integers exactly and has fast tile products
        total = total + (queries.codes[rows, part].astype(np.float32) @ candidates.codes[:, part].astype(np.float32).T).astype(np.float64)
    near = total * queries.scales[rows, None] * candidates.scales
    room = queries.errors[rows, None] + queries.lengths[rows, None] * candidates.errors + SLACK
    return near - room, near + room


class Cell:
    """The best candidates of one query stripe, so far."""

    def __init__(self, qids: np.ndarray, vectors: np.ndarray, k: int):
        self.qids, self.queries, self.k = qids, Coded(vectors), k
        self.scores = np.full((len(qids), k), -np.inf)
        self.first = np.full((len(qids), k), NO_ID)
        self.ids = np.full((len(qids), k), None, object)
        self.own = np.zeros((len(qids), k), bool)

    def add(self, vectors: np.ndarray, ids: list[list]) -> None:
        candidates = Coded(vectors)
        first = np.array([NO_ID if x[0] is None else x[0] for x in ids], np.int64)
        for low in range(0, len(self.qids), TILE_QUERIES):
            rows = slice(low, low + TILE_QUERIES)
            lower, upper = tile_bounds(self.queries, rows, candidates)
            goal = self.scores[rows, -1]
            if len(ids) >= self.k:
                goal = np.maximum(goal, np.partition(lower, -self.k, axis=1)[:, -self.k])
            at, col = np.nonzero(upper >= goal[:, None] - SLACK)
            if len(at):
                self._keep(at + low, col, candidates, first, ids)

    def _keep(self, at: np.ndarray, col: np.ndarray, candidates: Coded, first: np.ndarray, ids: list[list]) -> None:
        """Recompute the surviving pairs and keep the k best of each query, the smaller id of equal ones."""
        score, own = np.empty(len(at)), np.empty(len(at), bool)
        step = max(1, PAIR_ENTRIES // candidates.vectors.shape[1])
        for i in range(0, len(at), step):
            a, c = at[i:i + step], col[i:i + step]
            x, y = self.queries.vectors[a], candidates.vectors[c]
            score[i:i + step] = _in_order(x * y) / (self.queries.norms[a] * candidates.norms[c])
            own[i:i + step] = (x == y).all(axis=1)
        asked = np.unique(at)
        row = np.concatenate([np.repeat(asked, self.k), at])
        score = np.concatenate([self.scores[asked].ravel(), score])
        small = np.concatenate([self.first[asked].ravel(), first[col]])
        own = np.concatenate([self.own[asked].ravel(), own])
        source = np.concatenate([np.full(len(asked) * self.k, -1), col])
        held = self.ids[asked].ravel()
        order = np.lexsort((small, -score, row))
        begins = np.searchsorted(row[order], asked)
        best = order[begins[:, None] + np.arange(self.k)]
        self.scores[asked], self.first[asked], self.own[asked] = score[best], small[best], own[best]
        chosen = np.full(best.shape, None, object)
        for i, j in np.ndindex(best.shape):
            b = best[i, j]
            chosen[i, j] = held[b] if source[b] < 0 else ids[source[b]]
        self.ids[asked] = chosen

    def result(self) -> pa.RecordBatch | None:
        """(qid, scores, ids, own): the k best rows of each query."""
        out = []
        for i, qid in enumerate(self.qids.tolist()):
            rows = [(score, x, own) for score, ids, own in zip(self.scores[i].tolist(), self.ids[i], self.own[i].tolist())
                    if ids is not None for x in ids]
            if rows:
                out.append((qid, *zip(*heapq.nsmallest(self.k, rows, key=_nearest))))
        return _batch(out, CELL_KINDS) if out else None


CELL_KINDS = {"qid": pa.int64(), "scores": pa.list_(pa.float64()), "ids": pa.list_(pa.int64()), "own": pa.list_(pa.bool_())}


def _nearest(row: tuple) -> tuple:
    """Order of (score, id, ...): nearest first, then the smaller id, null ids last."""
    return -row[0], row[1] is None, row[1] or 0


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The results of all cells in a stream of (cell, kind, key, ids, v), sorted by cell and kind: a cell's queries
    (kind 0) come before its candidates."""
    cell, held, ready = None, [], None

    def done() -> Iterator[pa.RecordBatch]:
        if ready is not None and (out := ready.result()) is not None:
            yield out

    for batch in batches:
        cells, kinds = (batch.column(i).to_numpy() for i in range(2))
        cuts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])])
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(cells)]):
            if cells[low] != cell:
                yield from done()
                cell, held, ready = cells[low], [], None
            part = batch.slice(low, high - low)
            if kinds[low] == 0:
                held.append((part.column(2).to_numpy(), _matrix(part.column(4))))
                continue
            if ready is None:
                if not held:
                    continue  # no query in this stripe
                ready = Cell(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), k)
                held = []
            for at in range(0, part.num_rows, TILE_CANDIDATES):
                tile = part.slice(at, TILE_CANDIDATES)
                ready.add(_matrix(tile.column(4)), tile.column(3).to_pylist())
    yield from done()


def _merge(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best of every query from a stream of cell results sorted by query."""
    qid, heap = None, []
    kinds = {"qid": pa.int64(), "found": pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64()), ("own", pa.bool_())]))}

    def told() -> tuple:
        return qid, [dict(zip(("score", "vec_id", "own"), r)) for r in sorted(heap, key=_nearest)]

    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != qid:
                if heap:
                    out.append(told())
                qid, heap = row[0], []
            heap = heapq.nsmallest(k, heapq.merge(heap, zip(*row[1:]), key=_nearest), key=_nearest)
        if out:
            yield _batch(out, kinds)
    if heap:
        yield _batch([told()], kinds)


def candidate_classes(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): every distinct vector with its k smallest ids."""
    by = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"))
    few = rows.distinct().withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= k)
    ids = F.transform(F.sort_array(F.collect_list(F.struct("nth", "vec_id"))), lambda x: x["vec_id"])
    return few.groupBy("v").agg(ids.alias("ids"))


def _stripe(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def nearest(df: DataFrame, asked: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row with ``asked``, a condition on ``vec_id``."""
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col).filter(F.exists("v", lambda x: x != 0))
    classes = staged(candidate_classes(rows, k + 1), "vector-classes")
    queries = staged(rows.filter(asked).distinct(), "queries")
    keyed = staged(queries.select("v").distinct().select(F.monotonically_increasing_id().alias("qid"), "v"), "query-vectors")

    n_queries, n_classes = keyed.count(), classes.count()
    width = len(keyed.first().v) if n_queries else 1
    stripes_q = max(1, -(-n_queries * width * 8 // STRIPE_BYTES))
    cores = spark.sparkContext.defaultParallelism
    stripes_c = max(1, -(-n_classes // STRIPE_ROWS), min(-(-n_classes // LEAST_ROWS), -(-2 * cores // stripes_q)))

    no_ids = F.lit(None).cast("array<bigint>")
    left = keyed.select(F.lit(0).alias("kind"), F.col("qid").alias("key"), no_ids.alias("ids"), "v",
                        (_stripe(F.col("qid"), stripes_q) * stripes_c).alias("base"),
                        F.explode(F.sequence(F.lit(0), F.lit(stripes_c - 1))).alias("other"))
    right = classes.select(F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("key"), "ids", "v",
                           _stripe(F.col("v"), stripes_c).alias("base"),
                           F.explode(F.sequence(F.lit(0), F.lit((stripes_q - 1) * stripes_c), F.lit(stripes_c))).alias("other"))
    grid = left.unionByName(right).select((F.col("base") + F.col("other")).alias("cell"), "kind", "key", "ids", "v")
    cells = grid.repartition(stripes_q * stripes_c, "cell").sortWithinPartitions("cell", "kind") \
        .mapInArrow(lambda batches: _search(batches, k + 1), CELLS)
    merged = cells.repartition("qid").sortWithinPartitions("qid").mapInArrow(lambda batches: _merge(batches, k + 1), MERGED)

    # a vector that many queries share would meet all of them in one task
    found = merged.join(keyed, "qid").select("v", "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    told = queries.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).join(found, ["v", "salt"])
    others = F.filter("found", lambda x: ~(x["own"] & x["vec_id"].eqNullSafe(F.col("vec_id"))))
    return told.select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("place", "near")).select(
        "query_id", (F.col("place") + 1).alias("rank"), "near.vec_id", "near.score")
