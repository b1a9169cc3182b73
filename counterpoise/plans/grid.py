"""Preprocessing chains and the preprocessing x model grid.

``run_grid`` fits every model on every preprocessed training set (Spark jobs),
then scores the test set ONCE with all models chained as prediction columns
and computes every confusion matrix in ONE grouped aggregation.  Each
preprocessed training set is persisted while its models are fitted and
released afterwards; HME output is checkpointed by the filter itself.

With a ``ledger`` the grid can be broken off and taken up again: a prep's finished cells
are written under (settings, prep) as soon as they are scored, and a later run with the same
settings leaves them out (an anti-join with the ledger), so it does only the rest.

``with_lineage`` runs steps one after the other and carries their names with every row, so
that chains can be checked row by row against what the first step made.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.operators import balance
from counterpoise.operators.bayes import MultinomialNB
from counterpoise.operators.evaluate import metrics_long
from counterpoise.operators.forest import fit_forest
from counterpoise.operators.neighbours import fcnn_select
from counterpoise.operators.noise import hme_filter
from counterpoise.operators.pcard import fit_pcard
from counterpoise.operators.scaling import MinMaxScaler
from counterpoise.operators.trees import fit_dt

SCALED = "_xs"


@dataclass
class GridParams:
    """Defaults are the published experiment's settings."""

    seed: int = 1
    dt_depth: int = 10
    dt_bins: int = 100
    rf_trees: int = 100
    rf_trees_ros180: int = 200
    rf_depth: int = 10
    rf_bins: int = 100
    pcard_trees: int = 50
    pcard_cuts: int = 10
    pcard_depth: int = 10
    nb_smoothing: float = 1.0
    hme_trees: int = 100
    hme_folds: int = 4
    hme_depth: int = 10
    fcnn_k: int = 3
    fcnn_max_rows: int = 5000
    ros_as_weights: bool = False
    parallelism: int = 8
    # preprocessed training sets alive (persisted) at once; each can be about
    # twice the training set after oversampling, so keep this small at scale
    prep_parallelism: int = 1
    # how wide forests and PCARD fit (None: by the session); results do not depend on it
    partitions: int | None = None
    rf_trees_by_prep: dict = field(default_factory=dict)


def _ros(rate):
    def run(df, p: GridParams):
        return balance.ros(df, rate, p.seed, as_weights=p.ros_as_weights)

    return run


def _rus(df, p):
    return balance.rus(df, p.seed)


def _hme(df, p):
    return hme_filter(df, num_trees=p.hme_trees, k=p.hme_folds, max_depth=p.hme_depth, seed=48151623 + p.seed - 1,
                      parallelism=p.parallelism, partitions=p.partitions, weight_col=_weight(df)).drop("fold")


def _fcnn(df, p):
    return fcnn_select(df, k=p.fcnn_k, max_rows=p.fcnn_max_rows, seed=2015 + p.seed - 1, checkpoint=True).drop("bucket")


def _none(df, p):
    return df


STEPS = "steps"


def with_lineage(df: DataFrame, done: list[str], steps: list, p: GridParams) -> DataFrame:
    """``df`` through the named steps; each row says by ``steps`` (array of names) which ones it came through."""
    out = df.withColumn(STEPS, F.array(*map(F.lit, done)) if done else F.array().cast("array<string>"))
    for name, step in steps:
        out = step(out, p).withColumn(STEPS, F.array_append(STEPS, F.lit(name)))
    return out


def chain(*steps):
    def run(df, p):
        for s in steps:
            df = s(df, p)
        return df

    return run


# prep name -> (step, ROS rate or None); the published grid plus its chains
PREPS = {
    "none": (_none, None),
    "ros": (_ros(1.0), 1.0),
    "ros_115": (_ros(1.15), 1.15),
    "ros_140": (_ros(1.4), 1.4),
    "ros_150": (_ros(1.5), 1.5),
    "ros_180": (_ros(1.8), 1.8),
    "rus": (_rus, None),
    "hme": (_hme, None),
    "fcnn": (_fcnn, None),
    "ros_fcnn": (chain(_ros(1.8), _fcnn), 1.8),
    "fcnn_ros": (chain(_fcnn, _ros(1.0)), 1.0),
    "ros_hme": (chain(_ros(1.0), _hme), 1.0),
}
PUBLISHED_PREPS = ("none", "ros", "ros_115", "ros_140", "ros_150", "ros_180", "rus", "hme", "fcnn")
MODELS = ("dt", "rf", "pcard", "nb")


def _weight(df):
    return "weight" if "weight" in df.columns else None


def fit_model(name: str, train: DataFrame, prep: str, p: GridParams, scaler=None):
    w = _weight(train)
    if name == "dt":
        return fit_dt(train, p.dt_depth, p.dt_bins, weight_col=w, seed=p.seed)
    if name == "rf":
        trees = p.rf_trees_by_prep.get(prep, p.rf_trees_ros180 if prep in ("ros_180", "ros_fcnn") else p.rf_trees)
        return fit_forest(train, trees, p.rf_depth, p.rf_bins, weight_col=w, seed=p.seed, partitions=p.partitions)
    if name == "pcard":
        return fit_pcard(train, p.pcard_trees, p.pcard_cuts, p.pcard_depth, seed=p.seed, weight_col=w, partitions=p.partitions)
    if name == "nb":
        m = MultinomialNB(p.nb_smoothing, weight_col=w).fit(scaler.transform(train))
        m.features_col = SCALED
        return m
    raise ValueError(f"unknown model {name}")


def preprocess(train: DataFrame, prep: str, p: GridParams | None = None) -> DataFrame:
    return PREPS[prep][0](train, p or GridParams())


def run_grid(train: DataFrame, test: DataFrame, preps=PUBLISHED_PREPS, models=MODELS,
             params: GridParams | None = None, ledger: str | None = None) -> DataFrame:
    """Long metrics table ``prep, rate, model, tn, fp, fn, tp, n_null, n, accuracy, tnr, tpr, product``.

    ``ledger`` names a folder of finished cells (see above); the result then holds the
    asked cells from it, whichever run made them.
    """
    p = params or GridParams()
    if ledger is not None:
        return _resumed(train, test, preps, models, p, ledger)
    return _run_cells(train, test, preps, models, p)


def settings_key(p: GridParams) -> str:
    """What a finished cell depends on besides the data: all parameters but those of speed."""
    kept = {k: v for k, v in sorted(vars(p).items()) if k not in ("parallelism", "prep_parallelism", "partitions")}
    return hashlib.md5(repr(kept).encode()).hexdigest()[:16]


def _resumed(train: DataFrame, test: DataFrame, preps, models, p: GridParams, ledger: str) -> DataFrame:
    spark, key = train.sparkSession, settings_key(p)
    asked = spark.createDataFrame([(key, a, m) for a in preps for m in models], "settings string, prep string, model string")

    def finished() -> DataFrame | None:
        try:
            return spark.read.parquet(ledger)
        except AnalysisException as e:  # no cell yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return None

    known = finished()
    rest = asked if known is None else asked.join(known, ["settings", "prep", "model"], "left_anti")
    open_: dict[str, list[str]] = {}
    for r in rest.collect():  # cells of the grid
        open_.setdefault(r.prep, []).append(r.model)
    for prep in preps:
        if prep in open_:
            done = _run_cells(train, test, (prep,), tuple(m for m in models if m in open_[prep]), p)
            done.withColumn("settings", F.lit(key)).write.mode("append").parquet(ledger)
    cells = spark.read.parquet(ledger).join(F.broadcast(asked), ["settings", "prep", "model"], "left_semi")
    # Two runs at the same time can finish the same cell: it is the same row.
    return cells.drop("settings").dropDuplicates(["prep", "model"])


def _run_cells(train: DataFrame, test: DataFrame, preps, models, p: GridParams) -> DataFrame:
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    scaler = MinMaxScaler().fit(train) if "nb" in models else None
    fitted = {}

    def fit_prep(prep):
        pt = preprocess(train, prep, p)
        pt = pt.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPoolExecutor(max(1, min(p.parallelism, len(models)))) as pool:
                return prep, list(pool.map(lambda m: fit_model(m, pt, prep, p, scaler), models))
        finally:
            pt.unpersist()

    try:
        # Fits are independent Spark jobs over a shared cached input: they run
        # concurrently so the small per-level jobs of many trees overlap.
        with ThreadPoolExecutor(max(1, p.prep_parallelism)) as pool:
            for prep, ms in pool.map(fit_prep, preps):
                fitted.update({(prep, m): model for m, model in zip(models, ms)})
    finally:
        train.unpersist()
    scored = test.withColumn(SCALED, scaler.scaled()) if scaler else test
    cols = {}
    for (prep, m), model in fitted.items():
        col = f"p_{prep}_{m}"
        if hasattr(model, "predict_col"):  # NB, forests, PCARD: a column
            scored = scored.withColumn(col, model.predict_col())
        else:
            scored = model.transform(scored, prediction_col=col)
        cols[(prep, m)] = col
    out = metrics_long(scored, cols)
    rates = {k: v[1] for k, v in PREPS.items()}
    rate_col = F.lit(None).cast("double")
    for k, r in rates.items():
        if r is not None:
            rate_col = F.when(F.col("prep") == k, F.lit(r)).otherwise(rate_col)
    return out.select("prep", rate_col.alias("rate"), "model", *[c for c in out.columns if c not in ("prep", "model")])
