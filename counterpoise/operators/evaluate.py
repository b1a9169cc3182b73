"""Evaluation: confusion matrix, accuracy, TNR, TPR and their product.

One aggregation per scored frame (or one for a whole grid, grouped by
``prep, model``).  Rows are the actual class, columns the predicted one:
``tn = (0,0)``, ``fp = (0,1)``, ``fn = (1,0)``, ``tp = (1,1)``.  A NULL
prediction counts as an error and is also counted apart (``n_null``); an
empty denominator gives NULL (not NaN).

``orientation="swapped"`` reproduces the published decision-tree and forest
files, whose matrix was built from ``(label, prediction)`` pairs handed to a
``(prediction, label)`` API: there "TNR" is really the negative predictive
value ``tn/(tn+fn)`` and "TPR" the precision ``tp/(tp+fp)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import LABEL

PREDICTION = "prediction"
METRIC_COLUMNS = ("tn", "fp", "fn", "tp", "n_null", "n", "accuracy", "tnr", "tpr", "product")


def confusion(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: list[str] | None = None,
    weight_col: str | None = None,
) -> DataFrame:
    """``tn, fp, fn, tp, n_null, n`` (optionally grouped ``by`` columns)."""
    y, p = F.col(label_col), F.col(prediction_col)

    def cnt(cond):
        if weight_col:
            return F.sum(F.when(cond, F.col(weight_col)).otherwise(F.lit(0))).cast("long")
        return F.count_if(cond)

    aggs = [
        cnt((y == 0.0) & (p == 0.0)).alias("tn"),
        cnt((y == 0.0) & (p == 1.0)).alias("fp"),
        cnt((y == 1.0) & (p == 0.0)).alias("fn"),
        cnt((y == 1.0) & (p == 1.0)).alias("tp"),
        cnt(p.isNull()).alias("n_null"),
        (F.sum(F.col(weight_col)).cast("long") if weight_col else F.count(F.lit(1))).alias("n"),
    ]
    return (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)


def confusion_long(df: DataFrame, label_col: str = LABEL, prediction_col: str = PREDICTION,
                   by: list[str] | None = None) -> DataFrame:
    """Long-form matrix for any number of classes: ``(label, prediction, n)``.

    One grouped aggregation with map-side partial counts; pivot it with
    ``groupBy(label).pivot(prediction)`` when a square table is wanted.
    """
    keys = list(by or []) + [label_col, prediction_col]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def confusion_dense(df: DataFrame, classes: list, label_col: str = LABEL, prediction_col: str = PREDICTION) -> DataFrame:
    """Square matrix over a class dictionary, zero cells included: ``(label, prediction, n)`` with a row per pair of classes.

    One grouped aggregation pivoted over the fixed list (one pass, no look for the values);
    labels and predictions outside the dictionary, null ones too, are not in the square.
    """
    y, p = F.col(label_col), F.col(prediction_col)
    wide = df.where(y.isin(*classes)).select(y.alias("label"), p.alias("_p")).groupBy("label").pivot("_p", list(classes)).agg(F.count(F.lit(1)))
    known = df.sparkSession.createDataFrame([(c,) for c in classes], f"label {df.schema[label_col].dataType.simpleString()}")
    full = known.join(F.broadcast(wide), "label", "left")
    cells = F.array(*[F.struct(F.lit(c).alias("prediction"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("n")) for c in classes])
    return full.select("label", F.explode(cells).alias("c")).select("label", "c.prediction", "c.n")


def class_rates(df: DataFrame, classes: list, label_col: str = LABEL, prediction_col: str = PREDICTION) -> DataFrame:
    """One-versus-rest rates per class: ``tp, fp, fn, tn, n, recall, precision, specificity, f1`` (null where undefined).

    Every row counts, whatever its label and prediction: one outside the dictionary is a
    negative of each class.  One aggregation, three sums per class.
    """
    y, p = F.col(label_col), F.col(prediction_col)
    at = lambda c, k: F.coalesce(c == k, F.lit(False))
    sums = [a for i, k in enumerate(classes) for a in (F.count_if(at(y, k) & at(p, k)).alias(f"_tp{i}"), F.count_if(at(y, k)).alias(f"_y{i}"), F.count_if(at(p, k)).alias(f"_p{i}"))]
    one = df.agg(*sums, F.count(F.lit(1)).alias("n"))
    rows = F.array(*[F.struct(F.lit(k).alias("class"), F.col(f"_tp{i}").alias("tp"), (F.col(f"_p{i}") - F.col(f"_tp{i}")).alias("fp"), (F.col(f"_y{i}") - F.col(f"_tp{i}")).alias("fn"))
                     for i, k in enumerate(classes)])
    c = one.select("n", F.explode(rows).alias("c")).select("c.*", "n").withColumn("tn", F.col("n") - F.col("tp") - F.col("fp") - F.col("fn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("class", "tp", "fp", "fn", "tn", "n", _ratio(tp, tp + fn).alias("recall"), _ratio(tp, tp + fp).alias("precision"), _ratio(tn, tn + fp).alias("specificity"),
                    _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _ratio(a, b):
    return F.try_divide(a.cast("double"), b.cast("double"))


def rates(cm: DataFrame, orientation: str = "true") -> DataFrame:
    """Add ``accuracy, tnr, tpr, product`` to a confusion frame."""
    tn, fp, fn, tp, n = (F.col(c) for c in ("tn", "fp", "fn", "tp", "n"))
    if orientation == "true":
        tnr, tpr = _ratio(tn, tn + fp), _ratio(tp, fn + tp)
    elif orientation == "swapped":
        tnr, tpr = _ratio(tn, tn + fn), _ratio(tp, tp + fp)
    else:
        raise ValueError("orientation must be 'true' or 'swapped'")
    out = cm.withColumn("accuracy", _ratio(tn + tp, n)).withColumn("tnr", tnr).withColumn("tpr", tpr)
    return out.withColumn("product", F.col("tnr") * F.col("tpr"))


def evaluate(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: list[str] | None = None,
    orientation: str = "true",
) -> DataFrame:
    """Confusion matrix + rates of a scored frame in one aggregation."""
    return rates(confusion(df, label_col, prediction_col, by), orientation)


def metrics_long(scored: DataFrame, prediction_cols: dict[tuple[str, str], str], label_col: str = LABEL) -> DataFrame:
    """Metrics for many prediction columns of ONE scored frame in one pass.

    ``prediction_cols`` maps ``(prep, model)`` to a column.  The columns are
    stacked to long form (a narrow generator) and one grouped aggregation
    computes every matrix, so the test set is read once for a whole grid.
    """
    items = list(prediction_cols.items())
    expr = ", ".join(f"'{p}', '{m}', CAST(`{c}` AS DOUBLE)" for (p, m), c in items)
    long = scored.selectExpr(label_col, f"stack({len(items)}, {expr}) AS (prep, model, prediction)")
    return evaluate(long, label_col, "prediction", by=["prep", "model"])


def report_lines(metrics: DataFrame) -> DataFrame:
    """The classic six-line text report per ``(prep, model)`` as a ``value`` column.

    Line 1 carries accuracy under its historic name "Precision"; the matrix is
    printed row by row.  Write with ``.write.text`` (partitioned by prep/model).
    """
    def fmt(c):
        return F.col(c).cast("string")

    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Precision: "), fmt("accuracy")),
        F.concat(
            F.lit("Confusion Matrix "),
            F.col("tn").cast("double").cast("string"), F.lit("  "), F.col("fp").cast("double").cast("string"), F.lit("  \n"),
            F.col("fn").cast("double").cast("string"), F.lit("  "), F.col("tp").cast("double").cast("string"), F.lit("  "),
        ),
        F.concat(F.lit("TNR: "), fmt("tnr")),
        F.concat(F.lit("TPR: "), fmt("tpr")),
        F.concat(F.lit("Resultado: "), fmt("product")),
    )
    keys = [c for c in ("prep", "model") if c in metrics.columns]
    return metrics.select(*keys, body.alias("value"))
