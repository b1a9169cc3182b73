"""Exact k nearest rows by Euclidean distance, in blocks, skipping what cannot matter.

1. *Cells*: ``pivots`` rows (those with the smallest draws; their number is a parameter) are
   known to every task; each point belongs to the cell of its nearest pivot.
2. *Blocks*: a cell is cut into rings of equal distance to its pivot and, where many rows lie
   in one ring (copies of one vector have one distance), by a hash of the id: no block
   exceeds some ``block`` rows, however hot a cell is.
3. *Bounds*: queries are dealt into blocks the same way.  A first pass against one near
   block gives every query an upper bound of its k-th distance; by the triangle inequality
   a block whose ring is farther from the query block than that is skipped (whole cells first).
4. *Search*: the blocks left are joined by their numbers.  A task holds a group of query
   blocks, streams the blocks that any of them asks for past those that do, and keeps the best
   k rows of each query; only those leave the task.  A block is sent once to a group, not to
   every query block, and there are about as many groups as the cluster keeps busy, so what is
   moved grows with the rows, not with the pairs of blocks.  Lists of many blocks are split
   over several tasks and their short results merged.

Distances are sums of squared differences in double precision (a matrix product only
sorts out candidates), so equal vectors tie exactly; ties go to the smaller id.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL
from counterpoise.functions.hashing import hash_uniform
from counterpoise.session import scratch_path, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RINGS = 64  # rings of a cell at most; beyond that hashes cut
BLOCKS_PER_TASK = 2000
GROUP_BYTES = 128 << 20  # vectors of the query blocks that a task holds together


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):  # a row may be a whole block
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product: good to some 1e-12 of the squares' size."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(d, 0.0)


class Best:
    """The best k rows of each query seen so far: (squared distance, id, label), ties by id."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, k: int, others: bool):
        self.x, self.ids, self.k, self.others = x, ids, k, others
        self.of = np.zeros(0, np.int64)
        self.d, self.i, self.y = np.zeros(0), ids[:0], np.zeros(0)
        self.worst = np.full(len(x), np.inf)

    def add(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        rough = distances(self.x, points)
        slack = 1e-9 * ((self.x * self.x).sum(1) + (points * points).sum(1).max() + 1e-300)
        need = self.k + self.others
        limit = self.worst
        if need < len(points):
            limit = np.minimum(limit, np.partition(rough, need - 1, axis=1)[:, need - 1] + slack)
        q, p = np.nonzero(rough <= (limit + slack)[:, None])
        if self.others:
            apart = self.ids[q] != ids[p]
            q, p = q[apart], p[apart]
        if not len(q):
            return
        diff = self.x[q] - points[p]
        of, d = np.concatenate([self.of, q]), np.concatenate([self.d, (diff * diff).sum(1)])
        i, y = np.concatenate([self.i, ids[p]]), np.concatenate([self.y, labels[p]])
        order = np.lexsort((i, d, of))
        of = of[order]
        start = np.flatnonzero(np.diff(of, prepend=-1))
        rank = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
        keep = order[rank < self.k]
        self.of, self.d, self.i, self.y = np.concatenate([self.of, q])[keep], d[keep], i[keep], y[keep]
        full = np.flatnonzero(np.bincount(self.of, minlength=len(self.x)) == self.k)
        last = np.zeros(len(self.x))
        np.maximum.at(last, self.of, self.d)
        self.worst[full] = last[full]


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist()) if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)


def pack(rows: DataFrame, key: str) -> DataFrame:
    """``(key, ids, labels, x)``: all rows of a key (a bounded block) as one row, ``x`` as bytes of doubles."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        x = _matrix(t["x"].chunk(0))
        return pa.table({key: t[key][:1], "ids": pa.array([t["id"].to_pylist()], pa.list_(t["id"].type)), "labels": pa.array([t["label"].to_pylist()], pa.list_(pa.float64())),
                         "x": pa.array([x.tobytes()], pa.binary())})

    return rows.select(key, "id", "label", "x").groupBy(key).applyInArrow(run, f"{key} int, ids array<{kind}>, labels array<double>, x binary")


def shape_of(query_blocks: DataFrame) -> tuple[int, int]:
    """``(blocks, bytes)``: how many block numbers there are, and how large all vectors are."""
    r = query_blocks.agg(F.max("qb").alias("last"), F.sum(F.length("x")).alias("bytes")).first()
    return (0, 0) if r["last"] is None else (r["last"] + 1, r["bytes"])


def layout(tasks: int, blocks: int, size: int, most: int, share: float = 1.0, blocks_per_task: int = BLOCKS_PER_TASK, group_bytes: int = GROUP_BYTES) -> tuple[int, int]:
    """``(groups, slots)`` of ``blocks`` query blocks of ``size`` bytes and of their lists of up to ``most`` blocks.

    About ``tasks`` in all: queries are sent ``slots`` times and points ``groups`` times, which moves least when
    ``slots`` is the root of ``tasks * share``, ``share`` being the points for each query.  More where a
    group or a list would grow too long for a task.
    """
    slots = max(1, min(most, round(math.sqrt(tasks * share))))
    groups = max(1, min(blocks, max(math.ceil(tasks / slots), math.ceil(size / group_bytes))))
    return groups, max(slots, min(most, math.ceil(tasks / groups)), math.ceil(most / blocks_per_task))


def search(query_blocks: DataFrame, point_blocks: DataFrame, pairs: DataFrame, k: int, others: bool, blocks_per_task: int = BLOCKS_PER_TASK,
           most: int | None = None, shape: tuple[int, int] | None = None, share: float = 1.0) -> DataFrame:
    """``(id, d2, neighbour, label)``: of each query the best k rows among the blocks paired with its block ``(qb, block)``.

    ``most``: the largest number of blocks paired with one, if known; ``shape``: what ``shape_of`` says of the query blocks;
    ``share``: about how many points there are for each query.
    """
    kind = query_blocks.schema["ids"].dataType.elementType.simpleString()
    if most is None:
        most = pairs.groupBy("qb").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    blocks, size = shape or shape_of(query_blocks)
    groups, slots = layout(2 * query_blocks.sparkSession.sparkContext.defaultParallelism, blocks, size, most, share, blocks_per_task)
    # Query blocks with neighbouring numbers lie near each other and ask for the same blocks.
    group = F.floor(F.col("qb") * F.lit(groups) / F.lit(max(1, blocks))).cast("int")
    task = group * slots + F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")
    dealt = pairs.select("qb", "block", task.alias("task"))
    sent = dealt.groupBy("task", "block").agg(F.collect_set("qb").alias("asked_by"))
    none = F.lit(None).cast("array<int>")
    stream = query_blocks.join(dealt.select("qb", "task").distinct(), "qb").select("task", F.col("qb").cast("int").alias("qb"), none.alias("asked_by"), "ids", "labels", "x").unionByName(
        sent.join(point_blocks, "block").select("task", F.lit(-1).alias("qb"), F.col("asked_by").cast("array<int>").alias("asked_by"), "ids", "labels", "x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = {}, None

        def out():
            for qb, best in held.items():
                if len(best.of):
                    yield pa.record_batch({"qb": pa.array(np.full(len(best.of), qb, np.int32)), "row": pa.array(best.of.astype(np.int32)), "id": pa.array(best.ids[best.of]),
                                           "d2": pa.array(best.d), "neighbour": pa.array(best.i), "label": pa.array(best.y)})

        for b in batches:
            for row in range(b.num_rows):
                task, qb = b.column(0)[row].as_py(), b.column(1)[row].as_py()
                if task != at:
                    yield from out()
                    held, at = {}, task
                ids, labels = _ids(b.column(3)[row].values), b.column(4)[row].values.to_numpy(zero_copy_only=False)
                x = np.frombuffer(b.column(5)[row].as_py()).reshape(len(ids), -1)
                if qb >= 0:
                    held[qb] = Best(x, ids, k, others)
                else:
                    for asking in b.column(2)[row].as_py():
                        if asking in held:
                            held[asking].add(x, ids, labels)
        yield from out()

    # A task's query blocks come first, then the blocks that pass them.
    dealt_out = stream.repartitionById(groups * slots, F.col("task")).sortWithinPartitions("task", F.col("qb").desc())
    found = dealt_out.mapInArrow(run, f"qb int, row int, id {kind}, d2 double, neighbour {kind}, label double")
    return found.select("id", "d2", "neighbour", "label") if slots == 1 else best_of(found, k)


def search_sent(query_blocks: DataFrame, points: DataFrame, k: int, others: bool) -> DataFrame:
    """``search`` of all query blocks among few points ``(id, label, x)``, which are broadcast: no vector is shuffled.  The caller bounds them."""
    kind = query_blocks.schema["ids"].dataType.elementType.simpleString()
    got = points.toArrow().combine_chunks()
    x, ids, labels = (_matrix(got["x"].chunk(0)), _ids(got["id"].chunk(0)), got["label"].to_numpy()) if got.num_rows else (None, None, None)
    sent = query_blocks.sparkSession.sparkContext.broadcast((x, ids, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, ids, labels = sent.value
        for b in batches:
            for row in range(b.num_rows):
                own = _ids(b.column(0)[row].values)
                best = Best(np.frombuffer(b.column(1)[row].as_py()).reshape(len(own), -1), own, k, others)
                for lo in range(0, 0 if x is None else len(x), 512):
                    best.add(x[lo : lo + 512], ids[lo : lo + 512], labels[lo : lo + 512])
                if len(best.of):
                    yield pa.record_batch({"id": pa.array(best.ids[best.of]), "d2": pa.array(best.d), "neighbour": pa.array(best.i), "label": pa.array(best.y)})

    return query_blocks.select("ids", "x").mapInArrow(run, f"id {kind}, d2 double, neighbour {kind}, label double")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The best k of several short lists per query, a query being a row of its block: rows may share an id."""
    top = found.groupBy("qb", "row", "id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d2", "neighbour", "label"))), 1, k).alias("top"))
    return top.select("id", F.explode("top").alias("t")).select("id", "t.d2", "t.neighbour", "t.label")


def _rows(df: DataFrame, id_col: str, features_col: str, label_col: str) -> DataFrame:
    label = F.col(label_col).cast("double") if label_col in df.columns else F.lit(None).cast("double")
    return df.select(F.col(id_col).alias("id"), label.alias("label"), F.transform(features_col, lambda e: e.cast("double")).alias("x"))


def place(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot ``cell`` and the distances ``to`` all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                to = np.sqrt(distances(_matrix(b.column(2)), pivots))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to.argmin(1).astype(np.int32)), pa.array(to.tolist(), pa.list_(pa.float64()))], names=[*b.schema.names, "cell", "to"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, label double, x array<double>, cell int, to array<double>")


def blocks_of(placed: DataFrame, block: int) -> DataFrame:
    """``placed`` with a block number: rings of a cell, and hashes where a ring holds too many rows."""
    spark, r = placed.sparkSession, F.col("to")[F.col("cell")]
    n = {x["cell"]: x["n"] for x in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
    rings = {c: min(RINGS, math.ceil(m / block)) for c, m in n.items()}
    cuts = spark.createDataFrame([(c, [i / k for i in range(1, k)]) for c, k in rings.items()], "cell int, shares array<double>") if n else None
    if not n:
        return placed.withColumn("block", F.lit(0))
    share = placed.join(F.broadcast(cuts), "cell").select("cell", r.alias("r"), "shares")
    all_shares = sorted({s for c, k in rings.items() for s in (i / k for i in range(1, k))}) or [0.5]
    edges = share.groupBy("cell").agg(F.percentile_approx("r", F.array(*map(F.lit, all_shares)), 1000).alias("q")) if max(rings.values()) > 1 else None
    number = F.lit(0)
    if edges is not None:
        got = {x["cell"]: x["q"] for x in edges.collect()}  # at most RINGS shares of each pivot's cell
        own = [(c, [got[c][all_shares.index(i / k)] for i in range(1, k)]) for c, k in rings.items()]
        placed = placed.join(F.broadcast(spark.createDataFrame(own, "cell int, _edges array<double>")), "cell")
        number = F.size(F.filter("_edges", lambda e: e < r))
    ringed = placed.withColumn("_ring", number)
    counts = sorted((x["cell"], x["_ring"], x["n"]) for x in ringed.groupBy("cell", "_ring").agg(F.count(F.lit(1)).alias("n")).collect())
    first, table = 0, []
    for c, ring, m in counts:
        parts = math.ceil(m / block)
        table.append((c, ring, first, parts))
        first += parts
    numbered = ringed.join(F.broadcast(spark.createDataFrame(table, "cell int, _ring int, _first int, _parts int")), ["cell", "_ring"])
    return numbered.withColumn("block", F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")).select("id", "label", "x", "cell", "to", "block")


def topk_neighbours(points: DataFrame, k: int, queries: DataFrame | None = None, pivots: int | None = None, block: int = 512, query_block: int = 2048, seed: int = 1,
                    id_col: str = ID, features_col: str = FEATURES, label_col: str = LABEL, stats: dict | None = None) -> DataFrame:
    """``(id, rank, neighbour, distance, label)`` of the k nearest points of every query; ``label`` is the neighbour's.

    Without ``queries`` every point asks for its nearest others.  ``pivots`` defaults to one for
    two blocks of points, 64 at most.  ``stats`` receives the
    numbers of block pairs in all and searched.  Null feature arrays are not compared;
    fewer than k points give shorter lists; ids must be unique, long or string.
    """
    others = queries is None
    p = _rows(points, id_col, features_col, label_col).where("x IS NOT NULL")
    q = p if others else _rows(queries, id_col, features_col, label_col).where("x IS NOT NULL")
    pivots = pivots or min(64, 1 + p.count() // (2 * block))
    drawn = p.select("x", hash_uniform("id", f"pivots-{seed}").alias("u"), "id").orderBy("u", "id").limit(pivots).collect()
    if not drawn:
        return q.select("id", F.lit(1).alias("rank"), F.col("id").alias("neighbour"), F.lit(0.0).alias("distance"), F.lit(0.0).alias("label")).limit(0)
    centres = np.unique(np.array([r.x for r in drawn], float), axis=0)
    pb = _written(blocks_of(_written(place(p, centres), "topk-points"), block), "topk-point-blocks")
    qb = _written(blocks_of(_written(place(q, centres), "topk-queries") if not others else pb.drop("block"), query_block).withColumnRenamed("block", "qb"), "topk-query-blocks")
    point_blocks, query_blocks = _written(pack(pb, "block"), "topk-points"), _written(pack(qb, "qb"), "topk-queries")

    m, shape = len(centres), shape_of(query_blocks)
    at_pivot = lambda c: F.col("to")[c]
    about = pb.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n"), F.min(at_pivot(F.col("cell"))).alias("near"), F.max(at_pivot(F.col("cell"))).alias("far"))
    about = _written(about, "topk-about")
    cells = about.groupBy("cell").agg(F.min("near").alias("cell_near"), F.max("far").alias("cell_far"))
    # How near and far every query block is to every pivot: one row per pair, a join by cell from here on.
    spans = qb.groupBy("qb").agg(F.any_value("cell").alias("own"), F.array(*[F.struct(F.min(at_pivot(c)).alias("lo"), F.max(at_pivot(c)).alias("hi")) for c in range(m)]).alias("spans"))
    asks = spans.select("qb", "own", F.posexplode("spans").alias("cell", "s")).select("qb", "own", "cell", "s.lo", "s.hi")

    def gap(near: str, far: str):  # the least distance between a query of the block and a point of the ring
        return F.greatest(F.col("lo") - F.col(far), F.col(near) - F.col("hi"), F.lit(0.0))

    ask_cells = asks.join(F.broadcast(cells), "cell").withColumn("cell_gap", gap("cell_near", "cell_far"))
    close = ask_cells.where("cell = own").join(about, "cell").where(F.col("n") > k)
    first = close.groupBy("qb").agg(F.min_by("block", F.struct(gap("near", "far"), -F.col("n"), F.col("block"))).alias("block"))
    bounds = search(query_blocks, point_blocks, first, k, others, most=1, shape=shape).groupBy("id").agg(F.max("d2").alias("d2"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    limit = qb.select("qb", "id").join(bounds, "id", "left").groupBy("qb").agg(F.sqrt(F.max(F.coalesce("d2", F.lit(float("inf"))))).alias("limit"))
    limit = _written(limit, "topk-limits")
    slack = 1e-7  # rounding of the distances to pivots
    within = ask_cells.join(limit, "qb").where(F.col("cell_gap") <= F.col("limit") * (1 + slack) + slack * F.col("cell_far"))
    pairs = within.join(about, "cell").where(gap("near", "far") <= F.col("limit") * (1 + slack) + slack * F.col("far")).select("qb", "block")
    pairs = _written(pairs, "topk-pairs")
    if stats is not None:
        stats.update(all=spans.count() * about.count(), searched=pairs.count(), largest=about.agg(F.max("n")).first()[0])
    best = _written(search(query_blocks, point_blocks, pairs, k, others, shape=shape), "topk-best")
    listed = best.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d2", "neighbour", "label"))).alias("top"))  # k entries
    return listed.select("id", F.posexplode("top").alias("rank", "t")).select("id", (F.col("rank") + 1).alias("rank"), "t.neighbour", F.sqrt("t.d2").alias("distance"), "t.label")
