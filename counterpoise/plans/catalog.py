"""The registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver's tables in full (through the labelled-frame
builders) and returns a lazy DataFrame; model fits run as Spark jobs when the
query is built.  Queries without an oracle entry are checked by row count
here and by invariants in ``tests/``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import class_counts_map, split
from counterpoise.operators import balance, evaluate
from counterpoise.operators.bayes import MultinomialNB
from counterpoise.operators.scaling import MinMaxScaler, minmax
from counterpoise.plans import oracle_sql as S
from counterpoise.sources.tables import FRAMES, orders_labels

SEED = 1
SPLIT_SEED = 7
TRAIN_FRACTION = 0.7
RULE_MIN_LINES = 5.0  # deterministic rule predictor for the evaluation queries

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tagged(spark, sf_dir, names, fn) -> DataFrame:
    return _union([fn(FRAMES[n](spark, sf_dir)).select(F.lit(n).alias("frame"), "*") for n in names])


def _written(df: DataFrame) -> DataFrame:
    # Model queries read their frame several times (class counts, split
    # finding, fitting, scoring) and hand on a lazy result: compute it once, into
    # the shared folder.  Nothing stays in the session's cache, and a lost
    # executor costs no more than reading a part again.
    from counterpoise.session import scratch_path

    path = scratch_path(df.sparkSession, "frame")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sql_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


# ---------------------------------------------------------------- A1, A2, S3
ALL = ("emb", "toxic", "quality", "orders")


@query(
    "class_counts",
    _sql_union([f"SELECT '{n}' AS frame, label, count(*) AS n FROM ({S.LP[n]}) GROUP BY label" for n in ALL]),
)
def q_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, ALL, balance.class_counts)


@query(
    "class_fractions",
    _sql_union(
        [
            f"""SELECT '{n}' AS frame, n_neg, n_pos, n, CAST(CASE WHEN n_pos > n_neg THEN 0 ELSE 1 END AS DOUBLE) AS minority,
  CAST(greatest(n_neg, n_pos) AS DOUBLE) / NULLIF(CAST(least(n_neg, n_pos) AS DOUBLE), 0) AS imbalance_ratio
FROM (SELECT CAST(count_if(label = 0) AS BIGINT) AS n_neg, CAST(count_if(label = 1) AS BIGINT) AS n_pos,
             count(*) AS n FROM ({S.LP[n]}))"""
            for n in ALL
        ]
    ),
)
def q_class_fractions(spark, sf_dir):
    return _tagged(spark, sf_dir, ALL, balance.class_fractions)


# ---------------------------------------------------------------- B1, P7, P8, B3
def _ros_copies_sql(frame: str, rate: float = 1.0, seed=SEED) -> str:
    return f"WITH src AS ({S.LP[frame]}),\n{S.ros_copies_ctes('src', rate, seed)}\n"


@query(
    "ros_copies",
    _sql_union(
        [_ros_copies_sql(n) + f"SELECT '{n}' AS frame, id, label, copies FROM r_copies" for n in ("toxic", "quality")]
    ),
)
def q_ros_copies(spark, sf_dir):
    return _tagged(
        spark, sf_dir, ("toxic", "quality"), lambda df: balance.ros_copies(df, 1.0, SEED).select("id", "label", "copies")
    )


@query(
    "ros_rows",
    _ros_copies_sql("orders")
    + "SELECT id, label, CAST(UNNEST(range(1, copies + 1)) AS INTEGER) AS copy_no FROM r_copies WHERE copies > 0",
)
def q_ros_rows(spark, sf_dir):
    counts = class_counts_map(orders_labels(spark, sf_dir))
    return balance.ros(FRAMES["orders"](spark, sf_dir), 1.0, SEED, counts=counts).select("id", "label", "copy_no")


@query(
    "ros_weights",
    _ros_copies_sql("orders") + "SELECT id, label, CAST(copies AS DOUBLE) AS weight FROM r_copies WHERE copies > 0",
)
def q_ros_weights(spark, sf_dir):
    counts = class_counts_map(orders_labels(spark, sf_dir))
    return balance.ros(FRAMES["orders"](spark, sf_dir), 1.0, SEED, as_weights=True, counts=counts).select("id", "label", "weight")


ROS_FRAMES = ("toxic", "quality", "orders")


@query(
    "ros_class_counts",
    _sql_union(
        [
            _ros_copies_sql(n) + f"SELECT '{n}' AS frame, label, CAST(sum(copies) AS BIGINT) AS n FROM r_copies GROUP BY label"
            for n in ROS_FRAMES
        ]
    ),
)
def q_ros_class_counts(spark, sf_dir):
    def per_class(df):
        copies = balance.ros(df, 1.0, SEED, as_weights=True)  # no copies made to be counted
        return copies.groupBy("label").agg(F.sum("weight").cast("long").alias("n"))

    return _tagged(spark, sf_dir, ROS_FRAMES, per_class)


def _sweep_sql(frame: str) -> str:
    parts = []
    for r in balance.PUBLISHED_RATES:
        parts.append(
            f"""WITH src AS ({S.LP[frame]}),
{S.ros_copies_ctes('src', r, SEED)}
SELECT CAST({r!r} AS DOUBLE) AS rate, label, CAST(sum(copies) AS BIGINT) AS n,
  CASE WHEN label = (SELECT minority FROM r_par)
       THEN (SELECT CAST(greatest(n0, n1) AS DOUBLE) * {r!r} FROM r_cnt)
       ELSE (SELECT CAST(greatest(n0, n1) AS DOUBLE) FROM r_cnt) END AS expected
FROM r_copies GROUP BY label"""
        )
    return _sql_union(parts)


@query("ros_rate_sweep", _sweep_sql("toxic"))
def q_ros_rate_sweep(spark, sf_dir):
    return balance.rate_sweep(FRAMES["toxic"](spark, sf_dir), balance.PUBLISHED_RATES, SEED)


# ---------------------------------------------------------------- B2, P9
@query(
    "rus_rows",
    f"WITH src AS ({S.LP['orders']}),\n{S.rus_ctes('src', SEED)}\nSELECT id, label FROM u_kept",
)
def q_rus_rows(spark, sf_dir):
    counts = class_counts_map(orders_labels(spark, sf_dir))
    return balance.rus(FRAMES["orders"](spark, sf_dir), SEED, counts=counts).select("id", "label")


@query(
    "rus_class_counts",
    _sql_union(
        [
            f"WITH src AS ({S.LP[n]}),\n{S.rus_ctes('src', SEED)}\nSELECT '{n}' AS frame, label, count(*) AS n FROM u_kept GROUP BY label"
            for n in ROS_FRAMES
        ]
    ),
)
def q_rus_class_counts(spark, sf_dir):
    return _tagged(spark, sf_dir, ROS_FRAMES, lambda df: balance.class_counts(balance.rus(df, SEED)))


# ---------------------------------------------------------------- T2
@query(
    "minmax_scaled",
    f"WITH src AS ({S.LP['emb']}),\n{S.minmax_ctes('src')}\n"
    f"SELECT id, CAST(j AS INTEGER) AS j, x FROM ({S.scaled_long('src')})",
)
def q_minmax_scaled(spark, sf_dir):
    df = minmax(FRAMES["emb"](spark, sf_dir))
    return df.select("id", F.posexplode("features").alias("j", "x"))


# ---------------------------------------------------------------- M5, M6 (+ E on NB)
def _nb_sql(select: str, frame: str = "emb") -> str:
    train = S.split_sql(frame, "train", TRAIN_FRACTION, SPLIT_SEED)
    test = S.split_sql(frame, "test", TRAIN_FRACTION, SPLIT_SEED)
    return f"""WITH train AS ({train}),
test AS ({test}),
{S.minmax_ctes('train')},
{S.ros_copies_ctes('train', 1.0, SEED)},
sl AS ({S.scaled_long('train')}),
agg AS (SELECT sl.label, sl.j, sum(w.copies * sl.x) AS s FROM sl JOIN r_copies w ON sl.id = w.id GROUP BY sl.label, sl.j),
ncls AS (SELECT label, CAST(sum(copies) AS DOUBLE) AS n FROM r_copies GROUP BY label),
tot AS (SELECT sum(n) AS total FROM ncls),
dim AS (SELECT count(*) AS d FROM m_range),
th AS (SELECT label, j, ln(s + 1.0) - ln(sum(s) OVER (PARTITION BY label) + d * 1.0) AS theta FROM agg, dim),
prm AS (SELECT th.label, th.j, th.theta, ln(ncls.n + 1.0) - ln(tot.total + 2.0) AS pi
        FROM th JOIN ncls ON th.label = ncls.label, tot),
tl AS ({S.scaled_long('test')}),
sc AS (SELECT tl.id, tl.label, prm.label AS c, sum(tl.x * prm.theta) + any_value(prm.pi) AS score
       FROM tl JOIN prm ON tl.j = prm.j GROUP BY tl.id, tl.label, prm.label),
pred AS (SELECT id, label, CAST(max(score) FILTER (WHERE c = 1) > max(score) FILTER (WHERE c = 0) AS DOUBLE)
                 AS prediction FROM sc GROUP BY id, label)
{select}"""


def _nb_fit(spark, sf_dir, frame: str = "emb"):
    train, test = split(_written(FRAMES[frame](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)
    scaler = MinMaxScaler().fit(train)
    train_s = balance.ros(scaler.transform(train), 1.0, SEED, as_weights=True)
    model = MultinomialNB(weight_col="weight").fit(train_s)
    return model, scaler.transform(test)


@query(
    "nb_params",
    _nb_sql("SELECT label, CAST(j AS INTEGER) AS j, round(theta, 9) AS theta, round(pi, 9) AS pi FROM prm"),
)
def q_nb_params(spark, sf_dir):
    model, _ = _nb_fit(spark, sf_dir)
    return model.params(spark).select("label", "j", F.round("theta", 9).alias("theta"), F.round("pi", 9).alias("pi"))


@query("nb_predictions", _nb_sql("SELECT id, label, prediction FROM pred"))
def q_nb_predictions(spark, sf_dir):
    model, test = _nb_fit(spark, sf_dir)
    return model.transform(test).select("id", "label", "prediction")


def _metrics_sql(src: str, orientation: str = "true") -> str:
    if orientation == "true":
        tnr, tpr = "tn / NULLIF(tn + fp, 0)", "tp / NULLIF(fn + tp, 0)"
    else:
        tnr, tpr = "tn / NULLIF(tn + fn, 0)", "tp / NULLIF(tp + fp, 0)"
    return f"""SELECT tn, fp, fn, tp, n_null, n,
  CAST(tn + tp AS DOUBLE) / NULLIF(n, 0) AS accuracy,
  CAST({tnr} AS DOUBLE) AS tnr, CAST({tpr} AS DOUBLE) AS tpr,
  CAST({tnr} AS DOUBLE) * CAST({tpr} AS DOUBLE) AS product
FROM (SELECT CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
             CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
             CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
             CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
             CAST(count_if(prediction IS NULL) AS BIGINT) AS n_null, count(*) AS n FROM {src})"""


@query("nb_metrics", _nb_sql(_metrics_sql("pred")))
def q_nb_metrics(spark, sf_dir):
    model, test = _nb_fit(spark, sf_dir)
    return evaluate.evaluate(model.transform(test))


# ---------------------------------------------------------------- E1-E9, J2
def _rule_scored(spark, sf_dir) -> DataFrame:
    _, test = split(FRAMES["orders"](spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    return test.withColumn("prediction", (F.col("features")[1] >= F.lit(RULE_MIN_LINES)).cast("double"))


_RULE_SQL = (
    f"(SELECT *, CAST(features[2] >= {RULE_MIN_LINES!r} AS DOUBLE) AS prediction "
    f"FROM ({S.split_sql('orders', 'test', TRAIN_FRACTION, SPLIT_SEED)}))"
)


@query("confusion_matrix", f"SELECT tn, fp, fn, tp, n_null, n FROM ({_metrics_sql(_RULE_SQL)})")
def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_rule_scored(spark, sf_dir))


@query("rates", _metrics_sql(_RULE_SQL))
def q_rates(spark, sf_dir):
    return evaluate.evaluate(_rule_scored(spark, sf_dir))


@query("rates_swapped", _metrics_sql(_RULE_SQL, "swapped"))
def q_rates_swapped(spark, sf_dir):
    return evaluate.evaluate(_rule_scored(spark, sf_dir), orientation="swapped")


@query(
    "indexed_join",
    f"""SELECT t.id, t.label, p.prediction
FROM ({S.split_sql('orders', 'test', TRAIN_FRACTION, SPLIT_SEED)}) t
JOIN (SELECT id, prediction FROM {_RULE_SQL}) p ON t.id = p.id""",
)
def q_indexed_join(spark, sf_dir):
    scored = _rule_scored(spark, sf_dir)
    preds = scored.select("id", "prediction")
    _, test = split(FRAMES["orders"](spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    return test.select("id", "label").join(preds, "id", "inner")


# ---------------------------------------------------------------- M1, M2 (+ B1 feeding them)
def _orders_split(spark, sf_dir):
    return split(_written(FRAMES["orders"](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)


@query("dt_metrics")
def q_dt_metrics(spark, sf_dir):
    from counterpoise.operators.trees import fit_dt

    train, test = _orders_split(spark, sf_dir)
    model = fit_dt(balance.ros(train, 1.0, SEED, as_weights=True), max_depth=10, max_bins=100, weight_col="weight", seed=SEED)
    return evaluate.evaluate(model.transform(test))


@query("rf_metrics")
def q_rf_metrics(spark, sf_dir):
    from counterpoise.operators.forest import fit_forest

    train, test = _orders_split(spark, sf_dir)
    model = fit_forest(balance.ros(train, 1.0, SEED, as_weights=True), num_trees=100, max_depth=10, max_bins=100, weight_col="weight", seed=SEED)
    return evaluate.evaluate(model.transform(test))


# ---------------------------------------------------------------- M3, M4, T3, T4
@query("pcard_predict")
def q_pcard_predict(spark, sf_dir):
    from counterpoise.operators.pcard import fit_pcard

    train, test = split(_written(FRAMES["emb"](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)
    model = fit_pcard(balance.ros(train, 1.0, SEED, as_weights=True), trees=50, cuts=10, max_depth=10, seed=SEED, weight_col="weight")
    return model.transform(test).select("id", "label", "prediction")


DISC_MEMBERS, DISC_CUTS = 10, 10


@query(
    "discretized",
    f"""WITH src AS ({S.LP['emb']}),
ranked AS (SELECT features, row_number() OVER (ORDER BY {S.cut_draw('id', 1, SEED)}, id) - 1 AS r FROM src),
cutrows AS (SELECT r // {DISC_CUTS} AS member, features FROM ranked WHERE r < {DISC_MEMBERS * DISC_CUTS}),
cuts AS (SELECT member, UNNEST(range(0, len(features))) AS j, UNNEST(features) AS c FROM cutrows),
l AS ({S.long_form('src')}),
bins AS (SELECT c.member, l.j, l.id, count_if(c.c < l.x) AS bin
         FROM l JOIN cuts c ON c.j = l.j
         GROUP BY c.member, l.j, l.id)
SELECT CAST(member AS INTEGER) AS member, CAST(j AS INTEGER) AS j, CAST(bin AS DOUBLE) AS bin, count(*) AS n
FROM bins GROUP BY member, j, bin""",
)
def q_discretized(spark, sf_dir):
    from counterpoise.frame import num_features
    from counterpoise.operators.pcard import discretize, draw_cuts

    df = FRAMES["emb"](spark, sf_dir)
    table = draw_cuts(df, DISC_MEMBERS, DISC_CUTS, SEED, num_features(df))
    per_member = F.array(
        *[F.struct(F.lit(t).alias("member"), discretize("features", table[t]).alias("bins")) for t in range(len(table))]
    )
    m = df.select(F.explode(per_member).alias("m")).select("m.member", F.posexplode("m.bins").alias("j", "bin"))
    return m.groupBy("member", "j", "bin").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- T5, B4, B8
HME_K, HME_SEED = 4, 48151623


@query(
    "hme_folds",
    f"SELECT id, label, CAST(floor({S.hu('id', HME_SEED)} * {HME_K}.0) AS INTEGER) AS fold FROM ({S.LP['toxic']})",
)
def q_hme_folds(spark, sf_dir):
    from counterpoise.operators.noise import assign_folds

    return assign_folds(FRAMES["toxic"](spark, sf_dir), HME_K, HME_SEED).select("id", "label", "fold")


@query("hme_filter")
def q_hme_filter(spark, sf_dir):
    from counterpoise.operators.noise import hme_filter

    kept = hme_filter(FRAMES["toxic"](spark, sf_dir), num_trees=100, k=HME_K, seed=HME_SEED)
    return kept.select("id", "label", "fold")


def _chain_sql(frame: str, rate: float | None) -> str:
    """Per label the rows that the first step made; no row of the chain comes from elsewhere or from another step."""
    if rate is None:
        return f"SELECT label, count(*) AS made, CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS wrong_steps FROM ({S.LP[frame]}) GROUP BY label"
    return (_ros_copies_sql(frame, rate) + "SELECT label, CAST(sum(copies) AS BIGINT) AS made, CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS wrong_steps "
            "FROM r_copies GROUP BY label")


def _chain_report(made: DataFrame, out: DataFrame, steps: list[str]) -> DataFrame:
    """``made``: the rows that the first step had or made; ``out``: the chain's rows with their lineage."""
    from counterpoise.plans.grid import STEPS

    keys = ["id", "label"] + (["copy_no"] if "copy_no" in made.columns else [])
    bad = out.join(made.select(*keys), keys, "left_anti").groupBy("label").agg(F.count(F.lit(1)).alias("strangers"))
    wrong = out.where(F.col(STEPS) != F.array(*map(F.lit, steps))).groupBy("label").agg(F.count(F.lit(1)).alias("wrong_steps"))
    doubled = out.groupBy("id", "label", *(["copy_no"] if "copy_no" in out.columns else [])).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bad = bad.unionByName(doubled.groupBy("label").agg(F.count(F.lit(1)).alias("strangers"))).groupBy("label").agg(F.sum("strangers").alias("strangers"))
    total = made.groupBy("label").agg(F.count(F.lit(1)).alias("made"))
    return total.join(bad, "label", "left").join(wrong, "label", "left").select("label", "made", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("strangers", "wrong_steps")])


@query("ros_hme", _chain_sql("toxic", 1.0))
def q_ros_hme(spark, sf_dir):
    """Oversampling, then noise removal: every row left is a copy that the first step made."""
    from counterpoise.plans.grid import GridParams, with_lineage

    made = _written(balance.ros(FRAMES["toxic"](spark, sf_dir), 1.0, SEED))
    out = with_lineage(made, ["ros"], [("hme", lambda df, p: _hme_step(df))], GridParams())
    return _chain_report(made, _written(out), ["ros", "hme"])


def _hme_step(df: DataFrame) -> DataFrame:
    from counterpoise.operators.noise import hme_filter

    return hme_filter(df, num_trees=100, k=HME_K, seed=HME_SEED).drop("fold")


# ---------------------------------------------------------------- B5, B6, B7, T6
FCNN_SEED = 2015
FCNN_MAX_ROWS = 5000


def _fcnn_nb(n: int) -> int:
    import math

    return max(1, math.ceil(n / FCNN_MAX_ROWS))


@query(
    "fcnn_seed",
    f"""WITH src AS ({S.LP['emb']}),
nb AS (SELECT CAST(ceil(count(*) / {float(FCNN_MAX_ROWS)!r}) AS BIGINT) AS k FROM src),
b AS (SELECT s.*, CAST(floor({S.hu('s.id', FCNN_SEED)} * CAST(nb.k AS DOUBLE)) AS INTEGER) AS bucket FROM src s, nb),
l AS (SELECT id, label, bucket, UNNEST(range(0, len(features))) AS j, UNNEST(features) AS x FROM b),
cen AS (SELECT bucket, label, j, avg(x) AS c FROM l GROUP BY bucket, label, j),
dist AS (SELECT l.bucket, l.label, l.id, sum((l.x - cen.c) * (l.x - cen.c)) AS d
         FROM l JOIN cen ON l.bucket = cen.bucket AND l.label = cen.label AND l.j = cen.j
         GROUP BY l.bucket, l.label, l.id)
SELECT bucket, label, id FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket, label ORDER BY d, id) AS rn FROM dist) WHERE rn = 1""",
)
def q_fcnn_seed(spark, sf_dir):
    from counterpoise.operators.neighbours import fcnn_seeds

    df = FRAMES["emb"](spark, sf_dir)
    return fcnn_seeds(df, _fcnn_nb(df.count()), FCNN_SEED)


@query("fcnn_select")
def q_fcnn_select(spark, sf_dir):
    from counterpoise.operators.neighbours import fcnn_select

    out = fcnn_select(FRAMES["emb"](spark, sf_dir), k=3, max_rows=FCNN_MAX_ROWS, seed=FCNN_SEED)
    return out.select("id", "label", "bucket")


def _fcnn_step(df: DataFrame) -> DataFrame:
    from counterpoise.operators.neighbours import fcnn_select

    return fcnn_select(df, k=3, max_rows=FCNN_MAX_ROWS, seed=FCNN_SEED).drop("bucket")


@query("ros_fcnn", _chain_sql("emb", 1.8))
def q_ros_fcnn(spark, sf_dir):
    """Oversampling, then condensation: every row left is a copy that the first step made."""
    from counterpoise.plans.grid import GridParams, with_lineage

    made = _written(balance.ros(FRAMES["emb"](spark, sf_dir), 1.8, SEED))
    out = with_lineage(made, ["ros"], [("fcnn", lambda df, p: _fcnn_step(df))], GridParams())
    return _chain_report(made, _written(out), ["ros", "fcnn"])


@query("fcnn_ros", _chain_sql("emb", None))
def q_fcnn_ros(spark, sf_dir):
    """Condensation, then oversampling: every copy is of a row of the frame, and no copy number occurs twice."""
    from counterpoise.plans.grid import GridParams, with_lineage

    frame = _written(FRAMES["emb"](spark, sf_dir))
    steps = [("fcnn", lambda df, p: _fcnn_step(df)), ("ros", lambda df, p: balance.ros(df, 1.0, SEED))]
    return _chain_report(frame, _written(with_lineage(frame, [], steps, GridParams())), ["fcnn", "ros"])


# ---------------------------------------------------------------- E10, S9
@query("experiment_grid")
def q_experiment_grid(spark, sf_dir):
    from counterpoise.plans.grid import PREPS, GridParams, run_grid

    train, test = split(_written(FRAMES["toxic"](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)
    return run_grid(train, test, preps=tuple(PREPS), params=GridParams(prep_parallelism=3))


_RESUMED = tuple((p, m) for p in ("none", "ros", "rus") for m in ("dt", "nb"))


@query(
    "grid_resumed",
    _sql_union([f"SELECT '{p}' AS prep, '{m}' AS model, CAST(count_if(label = 0) AS BIGINT) AS negatives, CAST(count_if(label = 1) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS n_null "
                f"FROM ({S.split_sql('toxic', 'test', TRAIN_FRACTION, SPLIT_SEED)})" for p, m in _RESUMED]),
)
def q_grid_resumed(spark, sf_dir):
    """A grid that was broken off and taken up again: every cell stands once, and its matrix holds the whole test set by class."""
    from counterpoise.plans.grid import run_grid
    from counterpoise.session import scratch_path

    train, test = split(_written(FRAMES["toxic"](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)
    ledger = scratch_path(spark, "grid")
    run_grid(train, test, preps=("none", "ros"), models=("nb",), ledger=ledger)
    grid = run_grid(train, test, preps=("none", "ros", "rus"), models=("dt", "nb"), ledger=ledger)
    return grid.select("prep", "model", (F.col("tn") + F.col("fp")).alias("negatives"), (F.col("fn") + F.col("tp")).alias("positives"), "n_null")


@query(
    "metrics_report",
    _nb_sql(
        "SELECT 'ros' AS prep, 'nb' AS model, concat_ws(chr(10), 'Precision: ' || CAST(accuracy AS VARCHAR), "
        "'Confusion Matrix ' || CAST(CAST(tn AS DOUBLE) AS VARCHAR) || '  ' || CAST(CAST(fp AS DOUBLE) AS VARCHAR) || '  ', "
        "CAST(CAST(fn AS DOUBLE) AS VARCHAR) || '  ' || CAST(CAST(tp AS DOUBLE) AS VARCHAR) || '  ', "
        "'TNR: ' || CAST(tnr AS VARCHAR), 'TPR: ' || CAST(tpr AS VARCHAR), 'Resultado: ' || CAST(product AS VARCHAR)) AS value "
        f"FROM ({_metrics_sql('pred')})"
    ),
)
def q_metrics_report(spark, sf_dir):
    model, test = _nb_fit(spark, sf_dir)
    m = evaluate.evaluate(model.transform(test)).select(F.lit("ros").alias("prep"), F.lit("nb").alias("model"), "*")
    return evaluate.report_lines(m)


# ---------------------------------------------------------------- J1, S1, S2, S3, S4
@query(
    "row_index",
    """SELECT n, CAST(0 AS BIGINT) AS min_idx, n - 1 AS max_idx, CAST(n * (n - 1) // 2 AS BIGINT) AS sum_idx,
  CAST(CAST(n AS HUGEINT) * (n - 1) * (2 * n - 1) // 6 AS DOUBLE) AS sum_sq FROM (SELECT count(*) AS n FROM lineitem)""",
)
def q_row_index(spark, sf_dir):
    from counterpoise.operators.index import with_row_index
    from counterpoise.sources.tables import table

    return _index_sums(with_row_index(table(spark, sf_dir, "lineitem")))


def _index_sums(idx: DataFrame) -> DataFrame:
    return idx.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_index").alias("min_idx"),
        F.max("row_index").alias("max_idx"),
        # n numbers in 0 .. n-1 with these two sums are all different.
        F.sum("row_index").alias("sum_idx"),
        F.sum(F.col("row_index").cast("decimal(38,0)") * F.col("row_index")).cast("double").alias("sum_sq"),
    )


_ORDERS_WIDE_SQL = (
    "SELECT id, label, features[1] AS f0, features[2] AS f1, features[3] AS f2, features[4] AS f3, "
    f"features[5] AS f4 FROM ({S.LP['orders']})"
)


def _wide(df: DataFrame, d: int = 5) -> DataFrame:
    return df.select("id", "label", *[F.col("features")[j].alias(f"f{j}") for j in range(d)])


@query("csv_labelled_parse", _ORDERS_WIDE_SQL)
def q_csv_labelled_parse(spark, sf_dir):
    from counterpoise.sources.text import parse_labelled_csv

    lp = FRAMES["orders"](spark, sf_dir)
    lines = lp.select("id", F.concat_ws(",", *[F.col("features")[j].cast("string") for j in range(5)],
                                        F.col("label").cast("string")).alias("value"))
    good, _ = parse_labelled_csv(lines, num_fields=6)
    return _wide(good)


@query("keel_roundtrip", f"SELECT *, CAST(2 AS INTEGER) AS num_classes FROM ({_ORDERS_WIDE_SQL})")
def q_keel_roundtrip(spark, sf_dir):
    from counterpoise.session import scratch_path
    from counterpoise.sources.text import header_for, read_keel, write_keel

    lp = _written(FRAMES["orders"](spark, sf_dir))
    fitted = MinMaxScaler().fit(lp)
    names = [f"f{j}" for j in range(5)]
    header = header_for(names, list(zip(fitted.lo, fitted.hi)), "orders", id_attribute="id")
    path = scratch_path(spark, "keel-orders")
    write_keel(lp, header, path, id_attribute="id")
    good, _, h = read_keel(spark, f"{path}/header", f"{path}/data", scale=False, id_attribute="id")
    return _wide(good).withColumn("num_classes", F.lit(h.num_classes))


# ---------------------------------------------------------------- E1-E3 by error count, M5 via pyspark.ml, B4 report, T4
@query(
    "accuracy",
    f"""SELECT CAST(count_if(label <> prediction OR prediction IS NULL) AS BIGINT) AS errors, count(*) AS n,
  1.0 - CAST(count_if(label <> prediction OR prediction IS NULL) AS DOUBLE) / count(*) AS accuracy
FROM {_RULE_SQL}""",
)
def q_accuracy(spark, sf_dir):
    s = _rule_scored(spark, sf_dir)
    wrong = (F.col("label") != F.col("prediction")) | F.col("prediction").isNull()
    return s.agg(F.count_if(wrong).alias("errors"), F.count(F.lit(1)).alias("n")).select(
        "errors", "n", (F.lit(1.0) - F.try_divide(F.col("errors").cast("double"), F.col("n"))).alias("accuracy")
    )


@query("nb_ml_predictions", _nb_sql("SELECT id, label, prediction FROM pred"))
def q_nb_ml_predictions(spark, sf_dir):
    from counterpoise.functions.vectors import to_vector
    from counterpoise.operators.bayes import ml_naive_bayes

    train, test = split(FRAMES["emb"](spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    scaler = MinMaxScaler().fit(train)
    model = ml_naive_bayes(balance.ros(scaler.transform(train), 1.0, SEED, as_weights=True), weight_col="weight")
    scored = model.transform(scaler.transform(test).withColumn("_vec", to_vector("features")))
    return scored.select("id", "label", "prediction")


@query("hme_report")
def q_hme_report(spark, sf_dir):
    from counterpoise.operators.noise import hme_report

    return _written(hme_report(_hme_scored(spark, sf_dir)))


@query("pca_projection")
def q_pca_projection(spark, sf_dir):
    from counterpoise.operators.pca import fit_pca

    train, test = split(FRAMES["emb"](spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    model = fit_pca(train, k=3)
    return test.select("id", "label", model.project().alias("p")).select(
        "id", "label", *[F.col("p")[j].alias(f"pc{j}") for j in range(3)]
    )


@query("confusion_long", f"SELECT label, prediction, count(*) AS n FROM {_RULE_SQL} GROUP BY label, prediction")
def q_confusion_long(spark, sf_dir):
    return evaluate.confusion_long(_rule_scored(spark, sf_dir))


@query("nb_predictions_orders", _nb_sql("SELECT id, label, prediction FROM pred", "orders"))
def q_nb_predictions_orders(spark, sf_dir):
    model, test = _nb_fit(spark, sf_dir, "orders")
    return model.transform(test).select("id", "label", "prediction")


# ---------------------------------------------------------------- further SQL-checked results of the non-SQL operators
@query(
    "row_index_shuffled",
    """SELECT n, CAST(0 AS BIGINT) AS min_idx, n - 1 AS max_idx, CAST(n * (n - 1) // 2 AS BIGINT) AS sum_idx,
  CAST(CAST(n AS HUGEINT) * (n - 1) * (2 * n - 1) // 6 AS DOUBLE) AS sum_sq FROM (SELECT count(DISTINCT l_partkey) AS n FROM lineitem)""",
)
def q_row_index_shuffled(spark, sf_dir):
    """The index of a frame that comes out of a shuffle keeps every row."""
    from counterpoise.operators.index import with_row_index
    from counterpoise.sources.tables import table

    parts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return _index_sums(with_row_index(parts))


CUT_MEMBERS, CUTS = 50, 10


@query(
    "pcard_cuts",
    _ros_copies_sql("quality")
    + f"""SELECT CAST((rn - 1) // {CUTS} AS INTEGER) AS member, id FROM (
  SELECT id, row_number() OVER (ORDER BY u, id) AS rn FROM (
    SELECT id, min({S.cut_draw('id', 'k', SEED)}) AS u FROM (SELECT id, UNNEST(range(1, copies + 1)) AS k FROM r_copies WHERE copies > 0) GROUP BY id))
WHERE rn <= {CUT_MEMBERS * CUTS}""",
)
def q_pcard_cuts(spark, sf_dir):
    """The rows whose values are the members' cut points, after oversampling with the same seed: all different rows."""
    from counterpoise.operators.pcard import cut_rows

    return cut_rows(balance.ros(FRAMES["quality"](spark, sf_dir), 1.0, SEED), CUT_MEMBERS, CUTS, SEED).select("member", "id")


@query(
    "csv_rejected",
    f"""SELECT count(*) AS n, CAST(count(*) FILTER (WHERE id % 4 = 0) AS BIGINT) AS good, CAST(count(*) FILTER (WHERE id % 4 <> 0) AS BIGINT) AS rejected
FROM ({S.LP['orders']})""",
)
def q_csv_rejected(spark, sf_dir):
    """Three of four lines are spoilt: a field too few, a field too many, a label of 2."""
    from counterpoise.sources.text import parse_labelled_csv

    lp = FRAMES["orders"](spark, sf_dir)
    fields = [F.col("features")[j].cast("string") for j in range(5)]
    kind = F.col("id") % 4
    line = (F.when(kind == 1, F.concat_ws(",", *fields[1:], F.col("label").cast("string")))
            .when(kind == 2, F.concat_ws(",", *fields, F.lit("7.0"), F.col("label").cast("string")))
            .when(kind == 3, F.concat_ws(",", *fields, F.lit("2.0")))
            .otherwise(F.concat_ws(",", *fields, F.col("label").cast("string"))))
    good, bad = parse_labelled_csv(lp.select("id", line.alias("value")), num_fields=6)
    both = good.select(F.lit(1).alias("g")).unionByName(bad.select(F.lit(0).alias("g")))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("g") == 1).alias("good"), F.count_if(F.col("g") == 0).alias("rejected"))


@query(
    "keel_scaled",
    f"""WITH src AS ({S.LP['orders']}),
{S.minmax_ctes('src')}
SELECT label, j, count(*) AS n, round(sum(x), 6) AS total, round(min(x), 9) AS lo, round(max(x), 9) AS hi FROM (
  SELECT l.label, CAST(l.j AS INTEGER) AS j, CASE WHEN r.hi > r.lo THEN (l.x - r.lo) / (r.hi - r.lo) ELSE 0.0 END AS x
  FROM ({S.long_form('src')}) l JOIN m_range r ON l.j = r.j WHERE l.id % 10 <> 0)
GROUP BY label, j""",
)
def q_keel_scaled(spark, sf_dir):
    """KEEL text read with scaled inputs, a nominal class, no id, and every tenth line malformed."""
    from counterpoise.session import scratch_path
    from counterpoise.sources.text import header_for, read_keel, write_keel

    lp = _written(FRAMES["orders"](spark, sf_dir))
    fitted = MinMaxScaler().fit(lp)
    header = header_for([f"f{j}" for j in range(5)], list(zip(fitted.lo, fitted.hi)), "orders")
    path = scratch_path(spark, "keel-scaled")
    write_keel(lp.where("id % 10 <> 0"), header, path)
    lp.where("id % 10 = 0").select(F.concat_ws(",", F.lit("x"), F.col("id").cast("string")).alias("value")).write.mode("append").text(f"{path}/data")
    good, _, _ = read_keel(spark, f"{path}/header", f"{path}/data", scale=True)
    long = good.select("label", F.posexplode("features").alias("j", "x"))
    return long.groupBy("label", "j").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("total"),
                                          F.round(F.min("x"), 9).alias("lo"), F.round(F.max("x"), 9).alias("hi"))


def _hme_scored(spark, sf_dir) -> DataFrame:
    from counterpoise.operators.noise import hme_scored

    scored, folded = hme_scored(FRAMES["toxic"](spark, sf_dir), num_trees=100, k=HME_K, seed=HME_SEED)
    try:
        return _written(scored.select("id", "label", "fold", "prediction"))
    finally:
        folded.unpersist()


@query(
    "hme_fold_totals",
    f"""SELECT fold, label, count(*) AS n FROM (SELECT label, CAST(floor({S.hu('id', HME_SEED)} * {HME_K}.0) AS INTEGER) AS fold FROM ({S.LP['toxic']}))
GROUP BY fold, label""",
)
def q_hme_fold_totals(spark, sf_dir):
    """Kept and removed rows of the filter together are the folds."""
    from counterpoise.operators.noise import hme_report

    return hme_report(_hme_scored(spark, sf_dir)).select("fold", "label", (F.col("kept") + F.col("removed")).alias("n"))


@query(
    "fcnn_consistent",
    f"""WITH src AS ({S.LP['emb']}),
nb AS (SELECT CAST(ceil(count(*) / {float(FCNN_MAX_ROWS)!r}) AS BIGINT) AS k FROM src)
SELECT bucket, count(*) AS n, count(DISTINCT label) AS classes, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS strangers
FROM (SELECT s.label, CAST(floor({S.hu('s.id', FCNN_SEED)} * CAST(nb.k AS DOUBLE)) AS INTEGER) AS bucket FROM src s, nb) GROUP BY bucket""",
)
def q_fcnn_consistent(spark, sf_dir):
    """At k = 1 every row of a bucket is classified by the selection as labelled, which holds all classes and no strange rows."""
    from counterpoise.operators.neighbours import BUCKET, bucket_errors, fcnn_select
    from counterpoise.functions.hashing import hash_bucket

    df = _written(FRAMES["emb"](spark, sf_dir))
    nb = _fcnn_nb(df.count())
    chosen = fcnn_select(df, k=1, n_buckets=nb, seed=FCNN_SEED).select("id", F.lit(1).alias("chosen"))
    rows = df.withColumn(BUCKET, hash_bucket("id", FCNN_SEED, nb)).join(chosen, "id", "full")
    return bucket_errors(rows)


@query(
    "pca_variance",
    f"""SELECT round(sum(v), 6) AS total FROM (SELECT var_samp(x) AS v FROM ({S.long_form('(' + S.LP['emb'] + ')')}) GROUP BY j)""",
)
def q_pca_variance(spark, sf_dir):
    """All components together hold the frame's whole variance."""
    from counterpoise.operators.pca import fit_pca

    df = _written(FRAMES["emb"](spark, sf_dir))
    p = df.select(F.posexplode(fit_pca(df).project()).alias("j", "x"))
    return p.groupBy("j").agg(F.var_samp("x").alias("v")).agg(F.round(F.sum("v"), 6).alias("total"))


def _test_sizes_sql(frame: str, names) -> str:
    test = S.split_sql(frame, "test", TRAIN_FRACTION, SPLIT_SEED)
    return _sql_union([f"SELECT '{n}' AS model, label, count(*) AS n FROM ({test}) GROUP BY label" for n in names])


def _tree_models(spark, sf_dir):
    from counterpoise.operators.forest import fit_forest
    from counterpoise.operators.pcard import fit_pcard
    from counterpoise.operators.trees import fit_dt

    train, test = split(_written(FRAMES["emb"](spark, sf_dir)), TRAIN_FRACTION, SPLIT_SEED)
    w = _written(balance.ros(train, 1.0, SEED, as_weights=True))
    return {"dt": fit_dt(w, weight_col="weight", seed=SEED), "rf": fit_forest(w, 100, weight_col="weight", seed=SEED),
            "pcard": fit_pcard(w, 50, 10, 10, seed=SEED, weight_col="weight")}, test


@query("model_row_sums", _test_sizes_sql("emb", ("dt", "rf", "pcard")))
def q_model_row_sums(spark, sf_dir):
    """Every tree model predicts a class for every test row."""
    models, test = _tree_models(spark, sf_dir)
    scored = [m.transform(test).where(F.col("prediction").isin(0.0, 1.0)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(name).alias("model"), "label", "n") for name, m in models.items()]
    return _union(scored)


# ---------------------------------------------------------------- M1, M2, M6: trees as relations
BAG_TREES = 100


def _bags_sql(src: str, trees: int, seed=SEED) -> str:
    """CTE ``bags(id, tree, bag)``: how often each tree takes each row of ``src``."""
    return f"""steps AS (SELECT list(ceil(c * 4294967296.0)::BIGINT ORDER BY k) AS s FROM (
  SELECT k, sum(exp(-1.0 - lgamma(k + 1))) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM range(0, 14) t(k)) WHERE c * 4294967296.0 < 4294967296.0),
digests AS (SELECT id, b, md5('{seed}:bag-' || b || ':' || id) AS h FROM {src}, range(0, {(trees + 3) // 4}) t(b)),
bags AS (SELECT id, CAST(4 * b + j AS INTEGER) AS tree,
    CAST(len(list_filter(s, lambda x: x <= ('0x' || substr(h, CAST(8 * j + 1 AS BIGINT), 8))::BIGINT)) AS TINYINT) AS bag
  FROM digests, range(0, 4) u(j), steps WHERE 4 * b + j < {trees})"""


@query(
    "forest_weights",
    f"WITH src AS ({S.LP['orders']}),\n{_bags_sql('src', BAG_TREES)}\n"
    "SELECT tree, CAST(bag AS INTEGER) AS bag, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM bags GROUP BY tree, bag",
)
def q_forest_weights(spark, sf_dir):
    """The bagging weights of every row and tree, by tree and weight."""
    from counterpoise.operators.forest import bag_weights

    drawn = bag_weights(orders_labels(spark, sf_dir), BAG_TREES, SEED)
    return drawn.groupBy("tree", F.col("bag").cast("int").alias("bag")).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "forest_leaf_counts",
    f"""WITH src AS ({S.split_sql('orders', 'train', TRAIN_FRACTION, SPLIT_SEED)}),
{S.ros_copies_ctes('src', 1.0, SEED)},
{_bags_sql('r_copies', BAG_TREES)}
SELECT b.tree, CAST(sum(CASE WHEN label = 0 THEN copies * bag ELSE 0 END) AS DOUBLE) AS class0,
  CAST(sum(CASE WHEN label = 1 THEN copies * bag ELSE 0 END) AS DOUBLE) AS class1, CAST(0 AS BIGINT) AS broken
FROM bags b JOIN r_copies r ON b.id = r.id GROUP BY b.tree""",
)
def q_forest_leaf_counts(spark, sf_dir):
    """The leaves of every tree hold its bag, class by class; ``broken`` counts inner nodes whose children do not add up to them."""
    from counterpoise.operators.forest import fit_forest

    train, _ = _orders_split(spark, sf_dir)
    model = fit_forest(balance.ros(train, 1.0, SEED, as_weights=True), num_trees=BAG_TREES, max_depth=10, max_bins=100, weight_col="weight", seed=SEED)
    nodes = _written(model.node_table(spark))
    child = nodes.select("tree", F.col("node").alias("left"), F.col("counts").alias("lc"))
    other = nodes.select("tree", F.col("node").alias("right"), F.col("counts").alias("rc"))
    sums = F.zip_with("lc", "rc", lambda a, b: a + b)
    broken = nodes.where("feature >= 0").join(child, ["tree", "left"], "left").join(other, ["tree", "right"], "left").where(~F.coalesce(sums == F.col("counts"), F.lit(False)))
    leaves = nodes.groupBy("tree").agg(*[F.sum(F.when(F.col("feature") < 0, F.col("counts")[c]).otherwise(0.0)).alias(f"class{c}") for c in (0, 1)])
    return leaves.join(broken.groupBy("tree").agg(F.count(F.lit(1)).alias("broken")), "tree", "left").withColumn("broken", F.coalesce("broken", F.lit(0)).cast("long"))


@query(
    "tree_join_scores",
    _sql_union([f"SELECT '{m}' AS model, count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM ({S.split_sql('emb', 'test', TRAIN_FRACTION, SPLIT_SEED)})" for m in ("dt", "rf", "pcard")]),
)
def q_tree_join_scores(spark, sf_dir):
    """Scoring by joins with the node table agrees with every model's own scoring, row by row."""
    from counterpoise.operators.tree_relation import ml_node_table, score_by_join

    models, test = _tree_models(spark, sf_dir)
    tables = {"dt": (ml_node_table(spark, models["dt"]), False, "features"), "rf": (models["rf"].node_table(spark), False, "features"),
              "pcard": (models["pcard"].forest.node_table(spark), True, models["pcard"].wide())}
    out = []
    for name, (nodes, votes, features) in tables.items():
        walked = score_by_join(test, _written(nodes), votes, features=features).withColumnRenamed("prediction", "walked")
        both = models[name].transform(test).select("id", "prediction").join(walked, "id", "left")
        out.append(both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("prediction").eqNullSafe(F.col("walked"))).alias("mismatches")).select(F.lit(name).alias("model"), "*"))
    return _union(out)


# ---------------------------------------------------------------- T6, M8, M7, B5
TOP_K = 5


def _emb_classes(spark, sf_dir) -> DataFrame:
    """embeddings with their own class numbers (ten classes) as labels."""
    from counterpoise.sources.tables import table

    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("double").alias("label"),
                                                     F.transform("embedding", lambda e: e.cast("double")).alias("features"))


_EMB_CLASSES = "SELECT vec_id AS id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings"


def _nearest_sql(queries: str, points: str, k: int, others: bool) -> str:
    return f"""SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, distance, class FROM (
  SELECT q.id, p.id AS neighbour, p.label AS class, list_distance(q.features, p.features) AS distance,
    row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.features, p.features), p.id) AS rank
  FROM {queries} q, {points} p {"WHERE q.id <> p.id" if others else ""}) WHERE rank <= {k}"""


@query("topk_neighbours", f"WITH src AS ({_EMB_CLASSES}) SELECT id, rank, neighbour, round(distance, 9) AS distance FROM ({_nearest_sql('src', 'src', TOP_K, True)})")
def q_topk_neighbours(spark, sf_dir):
    """Every vector's five nearest others."""
    from counterpoise.operators.topk import topk_neighbours

    return topk_neighbours(_emb_classes(spark, sf_dir), TOP_K).select("id", "rank", "neighbour", F.round("distance", 9).alias("distance"))


@query(
    "knn_predictions",
    f"""WITH src AS ({_EMB_CLASSES}),
train AS (SELECT * FROM src WHERE {S.hu('id', SPLIT_SEED)} < {TRAIN_FRACTION!r}), test AS (SELECT * FROM src WHERE {S.hu('id', SPLIT_SEED)} >= {TRAIN_FRACTION!r}),
near AS ({_nearest_sql('test', 'train', TOP_K, False)}),
votes AS (SELECT id, class, CAST(count(*) AS DOUBLE) AS w FROM near GROUP BY id, class),
best AS (SELECT id, max(w) AS support, sum(w) AS total FROM votes GROUP BY id)
SELECT v.id, min(v.class) AS prediction, any_value(b.support) AS support, any_value(b.total) AS total, count(*) > 1 AS tied
FROM votes v JOIN best b ON v.id = b.id AND v.w = b.support GROUP BY v.id""",
)
def q_knn_predictions(spark, sf_dir):
    """Ten classes, five neighbours, ties to the smallest class."""
    from counterpoise.operators.knn import knn_predict

    train, test = split(_emb_classes(spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    return knn_predict(train, test, TOP_K)


@query(
    "vote_rows",
    """WITH votes AS (SELECT l_orderkey AS id, l_returnflag AS class, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY ALL),
best AS (SELECT id, max(w) AS support, sum(w) AS total FROM votes GROUP BY id)
SELECT v.id, min(v.class) AS prediction, any_value(b.support) AS support, any_value(b.total) AS total, count(*) > 1 AS tied
FROM votes v JOIN best b ON v.id = b.id AND v.w = b.support GROUP BY v.id""",
)
def q_vote_rows(spark, sf_dir):
    """The lines of an order vote for its return flag: three classes, many ties."""
    from counterpoise.operators.knn import vote_rows
    from counterpoise.sources.tables import table

    return vote_rows(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("class")))


@query("fcnn_global", f"SELECT count(*) AS n, count(DISTINCT label) AS classes, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS strangers FROM ({S.LP['emb']})")
def q_fcnn_global(spark, sf_dir):
    """At k = 1 the selection classifies every row of the whole frame as labelled, holds all classes and only rows of the frame."""
    from counterpoise.operators.knn import knn_predict
    from counterpoise.operators.neighbours import fcnn_global

    df = _written(FRAMES["emb"](spark, sf_dir))
    chosen = _written(fcnn_global(df, k=1))
    strange = chosen.join(df, ["id", "label", "features"], "left_anti").agg(F.count(F.lit(1)).alias("strangers"))
    said = knn_predict(chosen, df, 1).select("id", "prediction")
    errors = df.join(said, "id", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("label").eqNullSafe(F.col("prediction"))).alias("errors"))
    facts = errors.unionByName(strange, allowMissingColumns=True).unionByName(chosen.agg(F.count_distinct("label").alias("classes")), allowMissingColumns=True)
    return facts.agg(*[F.max(c).alias(c) for c in ("n", "classes", "errors", "strangers")])


# ---------------------------------------------------------------- E4-E7 for n classes, S9
LANGS = ("en", "fr", "de", "es")


def _lang_scored(spark, sf_dir) -> DataFrame:
    from counterpoise.sources.tables import table

    t = F.col("text")
    rule = F.when(t.contains(" the "), "en").when(t.contains(" le "), "fr").when(t.contains(" der "), "de").when(t.contains(" el "), "es")
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), rule.alias("prediction"))


_LANG_SQL = """(SELECT lang AS label, CASE WHEN contains(text, ' the ') THEN 'en' WHEN contains(text, ' le ') THEN 'fr'
  WHEN contains(text, ' der ') THEN 'de' WHEN contains(text, ' el ') THEN 'es' END AS prediction FROM documents)"""
_LANG_LIST = ", ".join(f"'{x}'" for x in LANGS)


@query("confusion_dense", f"""SELECT a.c AS label, b.c AS prediction, count(s.label) AS n
FROM (SELECT unnest([{_LANG_LIST}]) AS c) a CROSS JOIN (SELECT unnest([{_LANG_LIST}]) AS c) b LEFT JOIN {_LANG_SQL} s ON s.label = a.c AND s.prediction = b.c GROUP BY a.c, b.c""")
def q_confusion_dense(spark, sf_dir):
    """Languages against a rule by function words: sixteen cells, empty ones too."""
    return evaluate.confusion_dense(_lang_scored(spark, sf_dir), list(LANGS))


@query("class_rates", f"""SELECT class, tp, fp, fn, n - tp - fp - fn AS tn, n, tp / nullif(tp + fn, 0) AS recall, tp / nullif(tp + fp, 0) AS precision,
  (n - tp - fp - fn) / nullif(n - tp - fn, 0) AS specificity, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1
FROM (SELECT c AS class, CAST(count_if(coalesce(label = c AND prediction = c, false)) AS BIGINT) AS tp, CAST(count_if(coalesce(prediction = c, false) AND NOT coalesce(label = c, false)) AS BIGINT) AS fp,
        CAST(count_if(coalesce(label = c, false) AND NOT coalesce(prediction = c, false)) AS BIGINT) AS fn, count(*) AS n
      FROM {_LANG_SQL}, (SELECT unnest([{_LANG_LIST}]) AS c) GROUP BY c)""")
def q_class_rates(spark, sf_dir):
    return evaluate.class_rates(_lang_scored(spark, sf_dir), list(LANGS))


@query("metrics_sink", _sql_union([f"SELECT '{prep}' AS prep, 'rule' AS model, * FROM ({_metrics_sql(_RULE_SQL, how)})" for prep, how in (("first", "true"), ("second", "swapped"))]))
def q_metrics_sink(spark, sf_dir):
    """Two preps written one after the other, the second twice: both stand, once each."""
    from counterpoise.session import scratch_path
    from counterpoise.sources.sinks import write_metrics

    cm, path = _written(evaluate.confusion(_rule_scored(spark, sf_dir))), scratch_path(spark, "metrics")
    for prep, how in (("first", "true"), ("second", "true"), ("second", "swapped")):
        write_metrics(evaluate.rates(cm, how).select(F.lit(prep).alias("prep"), F.lit("rule").alias("model"), "*"), path)
    return spark.read.parquet(path).select("prep", "model", *evaluate.METRIC_COLUMNS)
