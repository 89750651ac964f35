"""Exact top-k cosine with an index of cells and a triangle bound per cell.

Items are unit vectors. Centres are fitted on a bounded hash sample of the items; every item belongs to its nearest centre, and a
cell knows its size and its angular radius (the widest angle between its centre and a member). For a query at angle ``phi``
from a centre, no member of the cell can be nearer than ``phi - radius``, so ``cos(max(0, phi - radius))`` bounds every score in
the cell.

A query first visits its home cells, those of highest bound until they hold ``k`` items; the ``k``-th score found there is a floor.
Such a visit is a row (cell, query); visits meet the items of their cell by a cogroup on (cell, shard, block): a cell of more than
``SHARD_ROWS`` items is cut into shards by item hash, and the visits of a cell beyond ``BLOCK_ROWS`` queries into blocks by query
hash, so neither a cell of copies nor a query that visits everything lands in one task.

Then it is scored against every cell whose bound reaches the floor, and no other. No row is made for that: queries that are near
the same centres are held as a block of bounded size by a task, and the cells that any of them needs stream past it, a cell at a
time, of which each query only meets those that it needs itself. What is moved is a copy of an item per block, however
many cells a query needs. Inside a task one integer orders by rounded score, then by item id, and only the best ``k`` of each
query leave it.

Scores are the cosine rounded to six places; ties go to the smaller item id, as in ``similarity.topk_cosine``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skillweave.functions.vectors import to_matrix, unit_rows
from skillweave.operators.ranking import top_within
from skillweave.operators.similarity import BLOCK_VALUES, NO_FLOOR, SCALE, _Best
from skillweave.session import written

CELL_ROWS = 2_000
MAX_CELLS = 4_096
SAMPLE_ROWS = 50_000
SHARD_ROWS = 20_000
BLOCK_ROWS = 20_000
#: Rows turned into a matrix, or sent on, at once.
READ_ROWS = 2_048
FIT_ROUNDS = 5
#: Room for float error in bounds: a cell is skipped only when its bound is below the floor by more than this.
MARGIN = 4e-6
#: A product in blocks of another shape may round a score one step lower.
STEP = 1.5e-6


def _matrix(values: pd.Series) -> np.ndarray:
    if not len(values):
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, np.float64) for v in values])


def _slices(frames: Iterator[pd.DataFrame], vector: str) -> Iterator[pd.DataFrame]:
    """Rows that have a vector, at most ``READ_ROWS`` at once, so that what is made of them stays small."""
    for frame in frames:
        frame = frame[frame[vector].notna()]
        for start in range(0, len(frame), READ_ROWS):
            yield frame.iloc[start : start + READ_ROWS]


def fit_centres(items: DataFrame, item_id: str, vector: str, cells: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """``cells`` unit centres by a few Lloyd rounds on the (at most ``sample_rows``) items of smallest id hash."""
    sample = (items.where(F.col(vector).isNotNull()).select(F.xxhash64(item_id).alias("h"), item_id, vector)
              .orderBy("h", item_id).limit(sample_rows).toPandas())
    points = unit_rows(_matrix(sample[vector]))
    centres = points[: max(1, min(cells, len(points)))].copy()
    for _ in range(FIT_ROUNDS):
        nearest = np.argmax(points @ centres.T, axis=1)
        for c in range(len(centres)):
            members = points[nearest == c]
            if len(members):
                centres[c] = members.sum(axis=0)
        centres = unit_rows(centres)
    return centres


def _cells_of(items: DataFrame, centres: np.ndarray, item_id: str, vector: str, carry: list[str]) -> DataFrame:
    shared = items.sparkSession.sparkContext.broadcast(centres)
    fields = [items.schema[c] for c in (item_id, *carry)]
    schema = T.StructType([*fields, items.schema[vector], T.StructField("cell", T.IntegerType()), T.StructField("cos", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mids = shared.value
        for frame in _slices(frames, vector):
            points = unit_rows(_matrix(frame[vector]))
            near = points @ mids.T
            cell = np.argmax(near, axis=1)
            out = frame[[item_id, *carry, vector]].copy()
            out["cell"] = cell.astype(np.int32)
            out["cos"] = near[np.arange(len(cell)), cell]
            yield out

    return items.select(item_id, *carry, vector).mapInPandas(run, schema)


def _bounds(q: np.ndarray, mids: np.ndarray, radius: np.ndarray) -> np.ndarray:
    phi = np.arccos(np.clip(q @ mids.T, -1.0, 1.0))
    return np.cos(np.maximum(0.0, phi - radius))


def _visits(queries: DataFrame, index: tuple, k: int, query_id: str, vector: str, floors: DataFrame | None) -> DataFrame:
    """(query, vector, cell, home) rows: home cells first, or with ``floors`` the other cells whose bound reaches the floor."""
    shared = queries.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([queries.schema[query_id], queries.schema[vector], T.StructField("cell", T.IntegerType())])
    source = queries.select(query_id, vector, F.lit(None).cast("double").alias("_floor")) if floors is None else queries.join(floors, query_id, "left")
    homes = floors is None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mids, radius, sizes = shared.value
        for frame in _slices(frames, vector):
            q = unit_rows(_matrix(frame[vector]))
            bound = _bounds(q, mids, radius)
            order = np.argsort(-bound, axis=1, kind="stable")
            reach = np.cumsum(sizes[order], axis=1)
            home = np.zeros_like(bound, dtype=bool)
            # home cells: the highest bounds until k items, all cells if there are fewer
            first = np.minimum(np.argmax(reach >= k, axis=1) + 1, bound.shape[1])
            first[reach[:, -1] < k] = bound.shape[1]
            for i in range(len(q)):
                home[i, order[i, : first[i]]] = True
            if homes:
                pick = home
            else:
                floor = frame["_floor"].to_numpy(np.float64, na_value=-np.inf)
                pick = ~home & (bound >= floor[:, None] - MARGIN)
            rows, cells = np.nonzero(pick)
            ids, given = frame[query_id].to_numpy(), frame[vector].to_numpy()
            for start in range(0, len(rows), READ_ROWS):
                some = rows[start : start + READ_ROWS]
                yield pd.DataFrame({query_id: ids[some], vector: given[some], "cell": cells[start : start + READ_ROWS].astype(np.int32)})

    return source.mapInPandas(run, schema)


def _nearest_places(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``q``, place in ``x``, score) of the best ``k`` of each query, scored block against block; ties to the first place."""
    best = _Best(np.arange(len(q)), q, np.full(len(q), NO_FLOOR), k)
    best.add([np.arange(len(x))], x)
    return best.found()


def _score(visits: DataFrame, placed: DataFrame, cells: DataFrame, k: int, query_id: str, item_id: str, vector: str, carry: list[str], out: T.StructType) -> DataFrame:
    """Best ``k`` items of each query among the cells it visits."""
    visits = written(visits, "cell_visits")
    per_cell = visits.groupBy("cell").agg(F.count("*").alias("v"))
    layout = cells.join(per_cell, "cell").select("cell", F.greatest(F.lit(1), F.ceil(F.col("size") / SHARD_ROWS)).cast("int").alias("shards"),
                                                 F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK_ROWS)).cast("int").alias("blocks"))
    layout = F.broadcast(layout)  # a row per cell, at most MAX_CELLS
    v = visits.join(layout, "cell").select(query_id, vector, "cell", F.pmod(F.xxhash64(query_id), F.col("blocks")).cast("int").alias("block"),
                                           F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    i = placed.join(layout, "cell").select(item_id, *carry, vector, "cell", F.pmod(F.xxhash64(item_id), F.col("shards")).cast("int").alias("shard"),
                                           F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def run(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({f.name: pd.Series(dtype=object) for f in out.fields})
        xs = xs.sort_values(item_id, kind="stable")
        rows, cols, scores = _nearest_places(_matrix(qs[vector]), _matrix(xs[vector]), k)
        got = {query_id: qs[query_id].to_numpy()[rows]}
        for c in (item_id, *carry):
            got[c] = xs[c].to_numpy()[cols]
        got["score"] = scores
        return pd.DataFrame(got)

    keys = ["cell", "shard", "block"]
    return v.groupBy(*keys).cogroup(i.groupBy(*keys)).applyInPandas(run, out)


def _index(items: DataFrame, item_id: str, vector: str, carry: list[str], cell_rows: int, sample_rows: int) -> tuple | None:
    """(items with their cell, (centres, radii, sizes), a row per cell), or None without items."""
    spark = items.sparkSession
    total = items.where(F.col(vector).isNotNull()).count()
    if not total:
        return None
    centres = fit_centres(items, item_id, vector, min(MAX_CELLS, math.ceil(total / cell_rows)), sample_rows)
    placed = written(_cells_of(items, centres, item_id, vector, carry), "cell_items")
    stats = placed.groupBy("cell").agg(F.count("*").alias("size"), F.min("cos").alias("low")).toPandas()  # a row per cell
    radius, sizes = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    radius[stats["cell"].to_numpy()] = np.arccos(np.clip(stats["low"].to_numpy(np.float64), -1.0, 1.0))
    sizes[stats["cell"].to_numpy()] = stats["size"].to_numpy()
    radius = np.where(sizes > 0, radius + 1e-9, -np.pi)  # an empty cell's bound stays below every floor
    cells = spark.createDataFrame(stats[["cell", "size"]].astype({"cell": "int32", "size": "int64"}))
    return placed, (centres, radius, sizes), cells


def _floors(first: DataFrame, k: int, query_id: str, item_id: str) -> DataFrame:
    ranked = top_within(first, [query_id], [F.desc("score"), F.asc(item_id)], k)
    return ranked.where(F.col("rank") == k).select(query_id, (F.col("score") - STEP).alias("_floor"))


def _layout(needed: int, cores: int) -> tuple[int, int]:
    """Blocks of queries, ``needed`` at least, and shards of items that give every core a task and move few copies."""
    if needed >= cores:
        return math.ceil(needed / cores) * cores, 1
    return min(((blocks, cores // blocks) for blocks in range(max(1, needed), cores + 1) if cores % blocks == 0), key=sum)


def _plain(column: pa.Array) -> np.ndarray:
    """Numbers as they are, all else and columns with nulls as objects."""
    kind = column.type
    if column.null_count or not (pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_boolean(kind)):
        return np.fromiter(column.to_pylist(), dtype=object, count=len(column))
    return column.to_numpy(zero_copy_only=False)


def _dealt(queries: DataFrame, floors: DataFrame, index: tuple, k: int, query_id: str, vector: str) -> tuple[DataFrame, int, int]:
    """(query, vector, floor, home, block) of the queries that have a vector; blocks of about one size, by home cell; blocks and shards."""
    mids = index[0]
    shared = queries.sparkSession.sparkContext.broadcast(mids)

    @F.arrow_udf(T.IntegerType())
    def home(vectors: pa.Array) -> pa.Array:
        parts = [unit_rows(to_matrix(vectors.slice(at, READ_ROWS))) @ shared.value.T for at in range(0, len(vectors), READ_ROWS)]
        return pa.array(np.concatenate([p.argmax(axis=1) for p in parts]).astype(np.int32) if parts else [], pa.int32())

    there = queries.where(F.col(vector).isNotNull()).join(floors, query_id, "left")
    placed = written(there.select(query_id, vector, "_floor", home(F.col(vector)).alias("_home"), F.monotonically_increasing_id().alias("_at")), "cell_queries")
    counts = placed.groupBy("_home").count().orderBy("_home").toPandas()  # a row per cell
    total = int(counts["count"].sum())
    blocks, shards = _layout(math.ceil(total / max(1, BLOCK_VALUES // (3 * k + 2 * mids.shape[1]))), queries.sparkSession.sparkContext.defaultParallelism)
    counts["_before"] = counts["count"].cumsum() - counts["count"]
    starts = F.broadcast(queries.sparkSession.createDataFrame(counts.astype({"_home": "int32"}), "_home int, count bigint, _before bigint"))
    # A place among the queries of the same home by hash: a home of many queries is spread over several blocks.
    place = F.col("_before") + F.floor(F.pmod(F.xxhash64("_at"), F.lit(1 << 20)) / F.lit(float(1 << 20)) * F.col("count"))
    block = F.floor(place * blocks / max(1, total)).cast("int").alias("_block")
    return placed.join(starts, "_home").select(query_id, vector, "_floor", "_home", block), blocks, shards


def _needed(dealt: DataFrame, index: tuple, vector: str) -> DataFrame:
    """(cell, blocks): the blocks of which a query may find something in the cell."""
    shared = dealt.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mids, radius, _ = shared.value
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, READ_ROWS):
                part = batch.slice(at, READ_ROWS)
                floor = part.column("_floor").fill_null(NO_FLOOR).to_numpy(zero_copy_only=False)
                reach = _bounds(unit_rows(to_matrix(part.column(vector))), mids, radius) >= floor[:, None] - MARGIN
                blocks = part.column("_block").to_numpy(zero_copy_only=False)
                for block in np.unique(blocks).tolist():
                    found[block] = found.get(block, False) | reach[blocks == block].any(axis=0)
        for block, cells in found.items():
            cells = np.flatnonzero(cells).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.full(len(cells), block, np.int32))], names=["cell", "block"])

    pairs = dealt.select(vector, "_floor", "_block").mapInArrow(run, "cell int, block int")
    return pairs.groupBy("cell").agg(F.collect_set("block").alias("_blocks"))


def _stream(dealt: DataFrame, blocks: int, shards: int, index: tuple, placed: DataFrame, k: int, query_id: str, item_id: str, vector: str, carry: list[str], out: T.StructType) -> DataFrame:
    """Best ``k`` items of each query among a shard of the items, all cells that its block needs streaming past the block."""
    spark = dealt.sparkSession
    values = dealt.schema[vector].dataType if dealt.schema[vector].dataType == placed.schema[vector].dataType else T.ArrayType(T.DoubleType())
    shard = F.pmod(F.xxhash64(item_id), F.lit(shards)).cast("int")
    left = dealt.select(F.explode(F.sequence(F.col("_block") * shards, F.col("_block") * shards + shards - 1)).alias("_task"), F.lit(0).alias("_role"),
                        F.col("_home").alias("_cell"), F.col(vector).cast(values).alias("_vector"), F.col(query_id).alias("_query"), "_floor")
    needed = F.broadcast(_needed(dealt, index, vector))  # a row per cell
    right = placed.join(needed, "cell").select(F.explode(F.transform("_blocks", lambda b: b * shards + shard)).alias("_task"), F.lit(1).alias("_role"),
                                               F.col("cell").alias("_cell"), F.col(vector).cast(values).alias("_vector"), item_id, *carry)
    met = left.unionByName(right, allowMissingColumns=True).repartitionById(blocks * shards, "_task").sortWithinPartitions("_role", "_cell")
    schema = to_arrow_schema(out)
    inside = schema.insert(len(schema) - 1, pa.field("_missing", pa.bool_()))
    shared = spark.sparkContext.broadcast(index)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mids, radius, _ = shared.value
        waiting, best = [], None
        for batch in batches:
            first = int(np.searchsorted(batch.column("_role").to_numpy(), 1))
            block, part = batch.slice(0, first), batch.slice(first)
            if first:
                floors = block.column("_floor").fill_null(NO_FLOOR).to_numpy(zero_copy_only=False)
                waiting.append((np.fromiter(block.column("_query").to_pylist(), dtype=object, count=first), to_matrix(block.column("_vector")), floors))
            if not part.num_rows or not (waiting or best):
                continue
            if best is None:
                best, waiting = _Best(*[np.concatenate(some) for some in zip(*waiting)], k), []
            ids = part.column(item_id)
            there = ids.is_valid().to_numpy(zero_copy_only=False)  # a missing id is the least
            least = "" if pa.types.is_string(ids.type) else pc.min(ids).as_py() or 0
            columns = [_plain(ids.fill_null(least)), *[_plain(part.column(c)) for c in carry], ~there]
            points, cell = to_matrix(part.column("_vector")), part.column("_cell").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for start, end in zip(edges[:-1], edges[1:]):
                at = cell[start]
                bound = _bounds(best.queries, mids[at : at + 1], radius[at : at + 1])[:, 0]
                best.add([c[start:end] for c in columns], points[start:end], bound >= best.lowest() - MARGIN)
        if best is not None:
            for found in best.batches(inside):
                ids = pc.if_else(found.column("_missing"), pa.scalar(None, found.column(item_id).type), found.column(item_id))
                yield pa.RecordBatch.from_arrays([ids if c == item_id else found.column(c) for c in schema.names], schema=schema)

    return met.mapInArrow(score, out)


def topk_cosine_cells(queries: DataFrame, items: DataFrame, k: int, query_id: str = "JobID", item_id: str = "ID", vector: str = "embedding",
                      carry: list[str] | None = None, cell_rows: int = CELL_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query, item, carried columns, score, rank) of the ``k`` nearest items of every query, equal to scoring all pairs.

    Null vectors take no part: such a query gets no rows, such an item is never found. Zero vectors score 0. Repeated items are
    found as often as they occur; repeated queries give their rows again. Empty tables give no rows; columns of other names
    are ignored. ``cell_rows`` sets the number of cells (items / cell_rows, at most ``MAX_CELLS``) and ``sample_rows`` the
    sample the centres are fitted on; both change the work, never the rows.
    """
    carry = carry or []
    spark = queries.sparkSession
    out = T.StructType([queries.schema[query_id], *[items.schema[c] for c in (item_id, *carry)], T.StructField("score", T.DoubleType())])
    built = _index(items.select(item_id, *carry, vector), item_id, vector, carry, cell_rows, sample_rows)
    if built is None:
        return top_within(spark.createDataFrame([], out), [query_id], [F.desc("score"), F.asc(item_id)], k)
    placed, index, cells = built
    queries = queries.select(query_id, vector)
    first = written(_score(_visits(queries, index, k, query_id, vector, None), placed, cells, k, query_id, item_id, vector, carry, out), "cell_home")
    dealt, blocks, shards = _dealt(queries, _floors(first, k, query_id, item_id), index, k, query_id, vector)
    found = _stream(dealt, blocks, shards, index, placed, k, query_id, item_id, vector, carry, out)
    return top_within(found, [query_id], [F.desc("score"), F.asc(item_id)], k)


def scored_share(queries: DataFrame, items: DataFrame, k: int, query_id: str = "JobID", item_id: str = "ID", vector: str = "embedding",
                 cell_rows: int = CELL_ROWS, sample_rows: int = SAMPLE_ROWS) -> float:
    """Share of all (query, item) pairs that ``topk_cosine_cells`` scores with these settings."""
    built = _index(items.select(item_id, vector), item_id, vector, [], cell_rows, sample_rows)
    nq = queries.where(F.col(vector).isNotNull()).count()
    if built is None or not nq:
        return 0.0
    placed, index, cells = built
    out = T.StructType([queries.schema[query_id], items.schema[item_id], T.StructField("score", T.DoubleType())])
    queries = queries.select(query_id, vector)
    home = _visits(queries, index, k, query_id, vector, None)
    first = written(_score(home, placed, cells, k, query_id, item_id, vector, [], out), "cell_home")
    rest = _visits(queries, index, k, query_id, vector, _floors(first, k, query_id, item_id))
    visited = home.select("cell").unionByName(rest.select("cell")).join(cells, "cell").agg(F.sum("size")).first()[0] or 0
    return float(visited) / (nq * int(index[2].sum()))
