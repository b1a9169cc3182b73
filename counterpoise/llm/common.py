"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from counterpoise.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ship(module_name: str) -> None:
    """Pickle a module's functions by value, so executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


#: Shuffle files go when a write is done; batches to Python are bounded by bytes, since texts have any length.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives a lost executor without redoing what led here.
    The shuffle files of the write are of no use after it and go with it, where the
    session's Spark can do that, so a job of many steps holds the disk of its largest one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {k: spark.conf.get(k) for k in _WHILE_WRITING if spark.conf.isModifiable(k)}
    for k in before:
        spark.conf.set(k, _WHILE_WRITING[k])
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables of ``staged`` that nothing reads any more; other frames are left alone."""
    for df in tables:
        path = getattr(df, "_staged_path", None)
        if path:
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


_BITS = 1 << 24  # of a table of marks: at most a 64th as many rows are broadcast, however many keys there are


def apart(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``key`` (a long) is certainly not in the one column of ``keys``, and the rest.

    A key sets one bit of a table of marks, which is broadcast.  Few other keys share a set bit,
    so an exact join of the rest by shuffle spares most rows that have no partner the way.
    """
    bit = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(_BITS).cast("long"))
    marks = keys.select(bit(F.col(keys.columns[0])).alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_bit & 63 as int)))").alias("_mask"))
    rows = df.withColumn("_bit", bit(key)).withColumn("_word", F.shiftright("_bit", 6)).join(F.broadcast(marks), "_word", "left")
    marked = F.coalesce(F.expr("(shiftrightunsigned(_mask, cast(_bit & 63 as int)) & 1) = 1"), F.lit(False))
    return rows.where(~marked).select(*df.columns), rows.where(marked).select(*df.columns)


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task and shares the executor's memory with the others."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def gapless(df: DataFrame, keys: list[str], order: list[str], out: str, n_rows: int, per_bucket: int = 5_000) -> DataFrame:
    """Number the rows of every key from 0 without gaps, by buckets of the order columns' hash.

    No task holds a whole key: a key's rows are numbered inside hash buckets of about
    ``per_bucket`` rows, and the buckets' offsets are prefix sums of their counts.
    """
    buckets = max(1, math.ceil(n_rows / per_bucket))
    rows = df.withColumn("_nb", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_nb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_nb")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_nb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_nb").orderBy(*order)) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(offsets, [*keys, "_nb"])
        .withColumn(out, (F.col("_first") + F.col("_inside")).cast("long"))
        .drop("_nb", "_first", "_inside")
    )


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of an undirected edge list: component = smallest node reachable.

    Hash-to-min with path shortening on edge tables: every round each node's edges are
    redirected to its smallest neighbour (large star, then small star) until the edges
    are stars.  The edge list is written to the shared folder each round, so the plan
    does not grow and a lost executor costs one round.  Isolated nodes have no row.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = staged(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    for _ in range(max_rounds):
        # Large star: every neighbour above u is linked to the smallest of u's neighbourhood.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every neighbour at or below u, and u, is linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        ).select("x.u", "x.v").where("u <> v").distinct()
        new = staged(small, "cc-edges")
        # Stars only: every node has one lower neighbour, and no centre has one itself.
        roots = new.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        open_ = roots.where("n > 1").limit(1).count() or new.join(new.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        free(e)
        e = new
        if not open_:
            break
    else:
        raise RuntimeError("connected components did not settle")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
    out._staged_path = e._staged_path
    return out
