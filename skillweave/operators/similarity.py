"""Exact nearest profiles by cosine, without ever holding all pairs.

Scores are computed block against block inside the tasks, and only the best ``k`` per query leave
a task. Few queries travel to the profiles, which then do not move. Many queries are cut into
blocks by hashed id, one task each, and all profiles stream past every block, so a query's best
``k`` come from one task and what is shuffled afterwards does not grow with the number of tasks.

Once a query has ``k`` items, single precision tells, with a margin for its error, which others could still
enter; only these are scored in double.

A score is the cosine rounded to six places; equal scores go by id. Sums in another order can only
differ at a rounding border, and the floors of the sample pass are one step lower for that reason.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.functions.vectors import cosine, to_matrix, unit_rows
from skillweave.operators.ranking import rank_within, top_within
from skillweave.session import written

MAX_BROADCAST_VALUES = 4_000_000
#: Rows a task may send to the merge when queries travel; more queries (times ``k``) go in blocks.
MAX_BROADCAST_RESULTS = 1_000_000
#: Numbers a task holds for its block of queries: vectors, and score, id and one carried column of ``k`` items.
BLOCK_VALUES = 16_000_000
SCALE = 1_000_000
ITEM_CHUNK = 2048
QUERY_CHUNK = 512
PRUNE_FROM_TASKS = 64
SAMPLE_SHARE = 64
NO_FLOOR = -2.0


def _cells(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values.tolist() if values.dtype == object else values, type=kind)


class _Best:
    """The best ``k`` items so far for one block of queries."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        self.query_ids, self.queries, self.floors, self.k = query_ids, unit_rows(queries), floors, k
        self.narrow = self.queries.astype(np.float32)
        # Twice the error bound of a single-precision product of unit vectors, and a rounding step.
        self.margin = (self.queries.shape[1] + 16) * 1.2e-7 + 1e-6
        self.scores: list[np.ndarray | None] = [None] * math.ceil(len(query_ids) / QUERY_CHUNK)
        self.items: list[list[np.ndarray]] = [[] for _ in self.scores]
        self.worst: list[np.ndarray | None] = [None] * len(self.scores)
        self.waiting: list[list[tuple]] = [[] for _ in self.scores]

    def add(self, columns: list[np.ndarray], vectors: np.ndarray, may: np.ndarray | None = None) -> None:
        """``columns`` are the item id and the columns carried along, all of one length; ``may``: the queries that these items can be among the best of."""
        order = np.argsort(columns[0], kind="stable")
        columns, vectors = [c[order] for c in columns], unit_rows(vectors[order])
        for start in range(0, len(vectors), ITEM_CHUNK):
            part = slice(start, start + ITEM_CHUNK)
            self._add_chunk([c[part] for c in columns], vectors[part], may)

    def lowest(self) -> np.ndarray:
        """The score below which an item can not be among the best, by query."""
        worst = [np.full(len(self.floors[b * QUERY_CHUNK : (b + 1) * QUERY_CHUNK]), NO_FLOOR) if w is None else w / SCALE for b, w in enumerate(self.worst)]
        return np.maximum(self.floors, np.concatenate(worst)) if worst else self.floors

    def _add_chunk(self, columns: list[np.ndarray], vectors: np.ndarray, may: np.ndarray | None = None) -> None:
        narrow, width = vectors.astype(np.float32).T, len(vectors)
        for b in range(len(self.scores)):
            block = slice(b * QUERY_CHUNK, (b + 1) * QUERY_CHUNK)
            who = None if may is None or may[block].all() else np.flatnonzero(may[block])
            if who is not None and not len(who):
                continue
            if self.worst[b] is not None:
                lowest = (self.worst[b] / SCALE - self.margin).astype(np.float32)
                some, lowest = (self.narrow[block], lowest) if who is None else (self.narrow[block][who], lowest[who])
                near = np.flatnonzero(some @ narrow >= lowest[:, None])
                if len(near) <= len(lowest) * self.k:
                    rows = near // width
                    self._wait(b, rows if who is None else who[rows], near % width, columns, vectors)
                    continue
            self._rank_all(b, columns, vectors)

    def _wait(self, b: int, rows: np.ndarray, at: np.ndarray, columns: list[np.ndarray], vectors: np.ndarray) -> None:
        """Score the few items that may enter the best of their query, and keep them until there are many."""
        products = np.einsum("ij,ij->i", self.queries[b * QUERY_CHUNK + rows], vectors[at])
        scores = np.rint(products * SCALE).astype(np.int64)
        good = scores >= self.worst[b][rows]
        if good.any():
            rows, scores, at = rows[good], scores[good], at[good]
            self.waiting[b].append((rows, scores, [c[at] for c in columns]))
            if sum(len(w[0]) for w in self.waiting[b]) > len(self.worst[b]) * self.k:
                self._settle(b)

    def _settle(self, b: int) -> None:
        """Merge the waiting items into the best; every query of the block has ``k`` by then."""
        if not self.waiting[b]:
            return
        rows, scores, items = zip(*self.waiting[b])
        count, k = self.scores[b].shape
        rows = np.concatenate([np.repeat(np.arange(count), k), *rows])
        scores = np.concatenate([self.scores[b].ravel(), *scores])
        found = [np.concatenate([old.ravel(), *new]) for old, new in zip(self.items[b], zip(*items))]
        order = np.lexsort((found[0], -scores, rows))
        each = np.bincount(rows, minlength=count)
        best = order[np.arange(len(order)) - np.repeat(np.cumsum(each) - each, each) < k]
        self._keep(b, scores[best].reshape(count, k), [c[best].reshape(count, k) for c in found])

    def _keep(self, b: int, scores: np.ndarray, items: list[np.ndarray]) -> None:
        self.scores[b], self.items[b], self.waiting[b] = scores, items, []
        self.worst[b] = scores.min(axis=1) if scores.shape[1] == self.k else None

    def _rank_all(self, b: int, columns: list[np.ndarray], vectors: np.ndarray) -> None:
        self._settle(b)
        width = len(vectors)
        block = self.queries[b * QUERY_CHUNK : (b + 1) * QUERY_CHUNK]
        scaled = np.rint(block @ vectors.T * SCALE).astype(np.int64)
        # One integer orders by score, then by id: the chunk is sorted by id, so by position.
        key = (SCALE - scaled) * width + np.arange(width)
        if width > self.k:
            key = np.partition(key, self.k - 1, axis=1)[:, : self.k]
        scores, at = SCALE - key // width, key % width
        found = [c[at] for c in columns]
        if self.scores[b] is not None:
            scores = np.concatenate([self.scores[b], scores], axis=1)
            found = [np.concatenate([old, new], axis=1) for old, new in zip(self.items[b], found)]
            if scores.shape[1] > self.k:
                best = np.lexsort((found[0], -scores), axis=1)[:, : self.k]
                scores = np.take_along_axis(scores, best, axis=1)
                found = [np.take_along_axis(c, best, axis=1) for c in found]
        self._keep(b, scores, found)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in range(len(self.scores)):
            if self.scores[b] is None:
                continue
            self._settle(b)
            block = slice(b * QUERY_CHUNK, (b + 1) * QUERY_CHUNK)
            scaled = self.scores[b] / SCALE
            useful = scaled >= self.floors[block, None]
            ids = np.repeat(self.query_ids[block], useful.sum(axis=1))
            data = [ids, *[c[useful] for c in self.items[b]], scaled[useful]]
            arrays = [_cells(values, field.type) for values, field in zip(data, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the query, item and score of all that was kept."""
        places, items, scores = [], [], []
        for b in range(len(self.scores)):
            if self.scores[b] is not None:
                self._settle(b)
                count, width = self.scores[b].shape
                places.append(np.repeat(np.arange(count) + b * QUERY_CHUNK, width))
                items.append(self.items[b][0].ravel())
                scores.append(self.scores[b].ravel() / SCALE)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, items, scores))

    def lists(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """(query, its items best first), one row per query id; rows of the same id share one list of ``k``."""
        names, first, group = np.unique([repr(i) for i in self.query_ids.tolist()], return_index=True, return_inverse=True)
        repeated = np.bincount(group, minlength=len(names))[group] > 1
        shared: dict[int, list[tuple]] = {}
        for b in range(len(self.scores)):
            if self.scores[b] is None:
                continue
            self._settle(b)
            start = b * QUERY_CHUNK
            best = np.lexsort((self.items[b][0], -self.scores[b]), axis=1)
            scores = np.take_along_axis(self.scores[b], best, axis=1)
            items = [np.take_along_axis(c, best, axis=1) for c in self.items[b]]
            single = ~repeated[start : start + len(scores)]
            yield self._list_batch(self.query_ids[start : start + len(scores)][single], scores[single], [c[single] for c in items], schema)
            for row in np.flatnonzero(~single):
                shared.setdefault(group[start + row], []).append((scores[row], [c[row] for c in items]))
        for at, parts in shared.items():
            scores = np.concatenate([p[0] for p in parts])
            items = [np.concatenate(c) for c in zip(*[p[1] for p in parts])]
            best = np.lexsort((items[0], -scores))[: self.k]
            yield self._list_batch(self.query_ids[first[at] : first[at] + 1], scores[None, best], [c[None, best] for c in items], schema)

    @staticmethod
    def _list_batch(ids: np.ndarray, scores: np.ndarray, items: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
        kind = schema.field(1).type
        fields = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]
        values = [_cells(v.ravel(), f.type) for v, f in zip([*items, scores / SCALE], fields)]
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * scores.shape[1])
        near = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, fields=fields)).cast(kind)
        return pa.RecordBatch.from_arrays([_cells(ids, schema.field(0).type), near], schema=schema)


def _arrow_schema(fields: list[T.StructField]) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in fields])


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column as numpy; strings become fixed-width so that they sort by code point."""
    column = batch.column(name)
    if pa.types.is_string(column.type):
        return np.array(column.to_pylist(), dtype=object)
    return column.to_numpy(zero_copy_only=False)


def topk_cosine(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_id: str = "JobID",
    item_id: str = "ID",
    vector: str = "embedding",
    carry: list[str] | None = None,
    max_broadcast_values: int = MAX_BROADCAST_VALUES,
    prune_from_tasks: int | None = PRUNE_FROM_TASKS,
) -> DataFrame:
    """(query, item, carried columns, score, rank) for the ``k`` nearest items of every query.

    ``carry`` names item columns (such as the category) that come along, which saves a join back.
    When queries travel to many tasks, a first pass over a hash sample of the items finds, per query, a
    score that ``k`` items reach. Nothing below it can be among the best, so tasks keep it to themselves
    and the merge does not grow with their number.
    """
    carry = carry or []
    spark = queries.sparkSession
    out = [
        T.StructField(query_id, queries.schema[query_id].dataType),
        *[T.StructField(c, items.schema[c].dataType) for c in (item_id, *carry)],
        T.StructField("score", T.DoubleType()),
    ]
    schema = _arrow_schema(out)
    queries, items = queries.select(query_id, vector), items.select(item_id, *carry, vector)
    width = queries.select(F.size(vector).alias("width")).where("width > 0").first()
    if width is None:
        return rank_within(spark.createDataFrame([], T.StructType(out)), [query_id], [F.desc("score"), F.asc(item_id)])
    few = max(1, min(max_broadcast_values // width["width"], MAX_BROADCAST_RESULTS // max(1, k)))
    head = queries.limit(few + 1).toArrow()
    if head.num_rows <= few:
        partial = _few_against_all(head, queries, items, k, query_id, item_id, carry, vector, max_broadcast_values, prune_from_tasks, out, schema)
    else:
        partial = _blocks_against_all(queries, items, k, query_id, [item_id, *carry], vector, _block_rows(k, width["width"], max_broadcast_values), T.StructType(out), lambda best: best.batches(schema))
    return top_within(partial, [query_id], [F.desc("score"), F.asc(item_id)], k)


def nearest_lists(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_id: str = "JobID",
    item_id: str = "ID",
    vector: str = "embedding",
    carry: list[str] | None = None,
    near: str = "near",
    max_broadcast_values: int = MAX_BROADCAST_VALUES,
    prune_from_tasks: int | None = PRUNE_FROM_TASKS,
) -> DataFrame:
    """The rows of :func:`topk_cosine` as (query, array of (item, carried columns, score)), best first.

    Blocks of queries end in one task each, so there the lists leave the task as they are and no (query, item) row is
    ever shuffled or sorted by Spark.
    """
    carry = carry or []
    inside = T.StructType([*[T.StructField(c, items.schema[c].dataType) for c in (item_id, *carry)], T.StructField("score", T.DoubleType())])
    queries, items = queries.select(query_id, vector), items.select(item_id, *carry, vector)
    width = queries.select(F.size(vector).alias("width")).where("width > 0").first()
    few = 0 if width is None else max(1, min(max_broadcast_values // width["width"], MAX_BROADCAST_RESULTS // max(1, k)))
    if width is None or queries.limit(few + 1).count() <= few:
        ranked = topk_cosine(queries, items, k, query_id, item_id, vector, carry, max_broadcast_values, prune_from_tasks)
        entry = F.struct("rank", F.struct(item_id, *carry, "score").alias("item"))
        found = ranked.groupBy(query_id).agg(F.sort_array(F.collect_list(entry)).alias("_ranked"))
        return found.select(query_id, F.transform("_ranked", lambda r: r["item"]).alias(near))
    out = T.StructType([T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(near, T.ArrayType(inside))])
    values = pa.list_(pa.struct(list(_arrow_schema(inside.fields))))
    schema = pa.schema([*_arrow_schema(out.fields[:1]), pa.field(near, values)])
    block_rows = _block_rows(k, width["width"], max_broadcast_values)
    return _blocks_against_all(queries, items, k, query_id, [item_id, *carry], vector, block_rows, out, lambda best: best.lists(schema))


def _block_rows(k: int, width: int, max_broadcast_values: int) -> int:
    return max(1, min(max_broadcast_values // width, BLOCK_VALUES // (3 * k + 2 * width)))


def _few_against_all(head, queries, items, k, query_id, item_id, carry, vector, max_broadcast_values, prune_from_tasks, out, schema) -> DataFrame:
    """Few queries with the floors of a sample pass, when they travel to many tasks."""
    spark = queries.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    floors = None
    if prune_from_tasks is not None and tasks >= prune_from_tasks:
        sample = items.where(F.pmod(F.xxhash64(item_id), F.lit(SAMPLE_SHARE)) == 0).drop(*carry)
        reached = topk_cosine(queries, sample, k, query_id, item_id, vector, None, max_broadcast_values, None)
        # One rounding step lower: a product in blocks of another shape may round the same score down.
        floors = written(reached.where(F.col("rank") == k).select(query_id, (F.col("score") - 1e-6).alias("_floor")), "floors")
    return _against_all(head, floors, items, k, query_id, [item_id, *carry], vector, out, schema)


def _against_all(head, floors, items, k, query_id, columns, vector, out, schema) -> DataFrame:
    """All queries, known to be few, against every partition of the items; the items stay in place."""
    batch = head.filter(pc.is_valid(head.column(vector))).combine_chunks()
    ids = np.array(batch.column(query_id).to_pylist(), dtype=object)
    known = {} if floors is None else {row[0]: row[1] for row in floors.collect()}
    lowest = np.array([known.get(i, NO_FLOOR) for i in ids.tolist()])
    shared = items.sparkSession.sparkContext.broadcast((ids, to_matrix(batch.column(vector)), lowest))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*shared.value, k)
        for part in batches:
            part = part.filter(pc.is_valid(part.column(vector)))
            if part.num_rows:
                best.add([_values(part, c) for c in columns], to_matrix(part.column(vector)))
        yield from best.batches(schema)

    # The scan keeps its splits, so a task reads what it would read anyway; the floors bound what it sends to the merge.
    return items.mapInArrow(score, T.StructType(out))


def _blocks_against_all(queries, items, k, query_id, columns, vector, block_rows, out, result) -> DataFrame:
    """A task per block of queries; within it the block comes first, then all items. ``result`` turns a block's best into batches."""
    there = F.col(vector).isNotNull()
    queries, items = queries.where(there), items.where(there)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    n_blocks = math.ceil(max(1, math.ceil(queries.count() / block_rows)) / cores) * cores
    left = queries.select(
        F.pmod(F.xxhash64(query_id), F.lit(n_blocks)).cast("int").alias("_block"),
        F.lit(0).alias("_role"),
        F.col(query_id).alias("_query"),
        F.col(vector).alias("_vector"),
    )
    right = items.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"), F.lit(1).alias("_role"), *columns, F.col(vector).alias("_vector")
    )
    met = left.unionByName(right, allowMissingColumns=True).repartitionById(n_blocks, "_block").sortWithinPartitions("_role")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, best = [], None
        for batch in batches:
            first = int(np.searchsorted(batch.column("_role").to_numpy(), 1))
            block, part = batch.slice(0, first), batch.slice(first)
            if block.num_rows:
                waiting.append((np.array(block.column("_query").to_pylist(), dtype=object), to_matrix(block.column("_vector"))))
            if part.num_rows and (waiting or best is not None):
                if best is None:
                    ids, vectors = [np.concatenate(part_of) for part_of in zip(*waiting)]
                    best, waiting = _Best(ids, vectors, np.full(len(ids), NO_FLOOR), k), []
                best.add([_values(part, c) for c in columns], to_matrix(part.column("_vector")))
        if best is not None:
            yield from result(best)

    return met.mapInArrow(score, out)


def rank_by_cosine(scored: DataFrame, query_id: str = "JobID", item_id: str = "ID") -> DataFrame:
    """Rank scored pairs per query, best first, equal scores by id."""
    return rank_within(scored, [query_id], [F.desc("score"), F.asc(item_id)])


def score_pairs(pairs: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """Cosine of two vector columns of the same row, as ``score``."""
    return pairs.withColumn("score", F.round(cosine(F.col(left), F.col(right)), 6))
