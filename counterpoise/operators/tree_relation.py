"""Fitted trees as a relation, and scoring by joins with it.

A node table has one row per node (``forest.NODE_SCHEMA``): tree, node, depth, the tested
feature and threshold (``x <= threshold`` goes left; feature -1 marks a leaf), the
children's numbers, class counts, their sum, the class of most, the gain.  Trees as rows
can be stored, compared and checked in SQL; ``score_by_join`` walks all rows down all
trees with one join per level and must agree with the model's own ``transform``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID
from counterpoise.operators.forest import spread_for
from counterpoise.session import scratch_path

MOST_BROADCAST = 2_000_000  # nodes; a larger table is joined by a shuffle


def ml_node_table(spark: SparkSession, scorer) -> DataFrame:
    """The node table of a fitted ``pyspark.ml`` tree or forest: its saved node data, read back."""
    path = scratch_path(spark, "tree-model")
    scorer.model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    forest = "treeID" in data.columns
    n = data.select((F.col("treeID") if forest else F.lit(0)).alias("tree"), "nodeData.*" if forest else "*")
    inner = F.col("split.featureIndex") >= 0
    flat = n.select("tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
                    F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                    F.col("impurityStats").alias("counts"), F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b).alias("n"), "prediction", "gain")
    return with_depth(flat)


def with_depth(nodes: DataFrame) -> DataFrame:
    """Adds ``depth``: roots (the smallest node of each tree) stand at 0; one join per level."""
    rows = nodes.select("tree", "node", "left", "right")
    at = rows.groupBy("tree").agg(F.min("node").alias("node")).withColumn("depth", F.lit(0))
    found, depth = at, 0
    while not at.isEmpty():
        depth += 1
        here = rows.join(at.select("tree", "node"), ["tree", "node"])
        at = here.where("left >= 0").select("tree", F.explode(F.array("left", "right")).alias("node")).withColumn("depth", F.lit(depth))
        found = found.unionByName(at)
    return nodes.join(found, ["tree", "node"])


def score_by_join(df: DataFrame, nodes: DataFrame, votes: bool = False, id_col: str = ID, features: Column | str = FEATURES, classes: int = 2) -> DataFrame:
    """``(id, prediction)``: every row walks down every tree, one join per level.

    A leaf gives its class shares, or with ``votes`` one vote for its class; ties go to the
    smaller class.  The node table is broadcast while it has at most ``MOST_BROADCAST`` rows
    (its size depends on the trees' number and depth, not on the data).
    """
    shape = nodes.agg(F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n")).first()
    if not shape.n:
        raise ValueError("no nodes")
    small = F.broadcast if shape.n <= MOST_BROADCAST else (lambda d: d)
    roots = nodes.where("depth = 0").select("tree", "node")
    x = F.col(features) if isinstance(features, str) else features
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    # Every row starts at every root: trees x rows is what a forest's vote is made of.
    first = [r.tree for r in roots.orderBy("tree").collect()]
    # The rows are spread first (a frame in one file would be walked by one task); their votes meet where they are.
    rows = df.select(F.col(id_col).alias("id"), x.alias("_x")).repartition(spread_for(df.sparkSession, len(first) * df.count()), "id")
    at = rows.select("id", "_x", F.explode(F.lit(first)).alias("tree")).join(F.broadcast(roots), "tree")
    for _ in range(shape.depth):
        down = F.when(F.col("feature") < 0, F.col("node")).when(F.col("_x")[F.greatest("feature", F.lit(0))] <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(small(steps), ["tree", "node"]).select("id", "_x", "tree", down.alias("node"))
    share = [F.when(F.col("prediction") == c, 1.0).otherwise(0.0) if votes else F.try_divide(F.col("counts")[c], F.col("n")) for c in range(classes)]
    leaf = at.select("id", "tree", "node").join(small(nodes.select("tree", "node", *[s.alias(f"_s{c}") for c, s in enumerate(share)])), ["tree", "node"])
    total = leaf.groupBy("id").agg(*[F.sum(f"_s{c}").alias(f"_s{c}") for c in range(classes)])
    best = F.greatest(*[F.struct(F.col(f"_s{c}").alias("s"), F.lit(-c).alias("c")) for c in range(classes)]) if classes > 1 else F.struct(F.col("_s0").alias("s"), F.lit(0).alias("c"))
    return total.select("id", (-best["c"]).cast("double").alias("prediction"))
