"""HME-BD style ensemble noise filter.

Rows are dealt into ``k`` folds by ``hash_bucket(id, seed, k)`` (copies of one
id always share a fold, so an oversampled row never votes on itself).  For
each fold a random forest is trained on the other folds and scores the fold;
rows whose out-of-fold prediction differs from their label are removed.

Plan: the folded input is persisted once and read by k fits (run from a small
thread pool) and k filtered scoring scans; the kept rows are then written to
the checkpoint folder (``checkpoint(eager=True)``) so that later fits do not
re-run k forests if an executor is lost.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import ID, LABEL
from counterpoise.functions.hashing import hash_bucket
from counterpoise.operators.forest import fit_forest
from counterpoise.session import checkpoint_dir

FOLD = "fold"


def assign_folds(df: DataFrame, k: int = 4, seed: int = 48151623, id_col: str = ID) -> DataFrame:
    return df.withColumn(FOLD, hash_bucket(id_col, seed, k))


def hme_scored(
    df: DataFrame,
    num_trees: int = 100,
    k: int = 4,
    max_depth: int = 10,
    max_bins: int = 32,
    seed: int = 48151623,
    weight_col: str | None = None,
    parallelism: int = 4,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(scored, folded)``: every row with its out-of-fold ``prediction``; caller unpersists ``folded``.

    The forests' bags are drawn from the ids, so they are the same whatever the input
    partitioning and the cluster; ``partitions`` only says how wide the fits run.
    ``weight_col`` reaches every forest.
    """
    folded = assign_folds(df, k, seed).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(f):
        return fit_forest(
            folded.where(F.col(FOLD) != f),
            num_trees=num_trees,
            max_depth=max_depth,
            max_bins=max_bins,
            weight_col=weight_col,
            seed=seed + f,
            partitions=partitions,
        )

    with ThreadPoolExecutor(max(1, min(parallelism, k))) as pool:
        models = list(pool.map(fit, range(k)))
    parts = [m.transform(folded.where(F.col(FOLD) == f)) for f, m in enumerate(models)]
    return reduce(lambda a, b: a.unionByName(b), parts), folded


def hme_filter(df: DataFrame, **kw) -> DataFrame:
    """Rows whose out-of-fold forest prediction equals their label (plus ``fold``), written to the checkpoint folder."""
    scored, folded = hme_scored(df, **kw)
    try:
        checkpoint_dir(df.sparkSession)
        return scored.where(F.col("prediction") == F.col(LABEL)).drop("prediction").checkpoint(eager=True)
    finally:
        folded.unpersist()


def hme_report(scored: DataFrame) -> DataFrame:
    """Kept / removed rows per fold and class of a ``hme_scored`` frame."""
    ok = F.col("prediction") == F.col(LABEL)
    return scored.groupBy(FOLD, LABEL).agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("removed"))
