"""Metric edge cases (FIXTURES F8)."""

from counterpoise.operators.evaluate import evaluate, metrics_long, report_lines


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "label double, prediction double")


def test_one_class_predicted(spark):
    r = evaluate(_frame(spark, [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)])).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 0, 2, 0)
    assert r.tnr == 1.0 and r.tpr == 0.0 and r.product == 0.0


def test_absent_class_gives_null_rate(spark):
    r = evaluate(_frame(spark, [(0.0, 0.0), (0.0, 1.0)])).first()
    assert r.tnr == 0.5 and r.tpr is None and r.product is None


def test_empty_frame(spark):
    r = evaluate(_frame(spark, [])).first()
    assert r.n == 0 and r.accuracy is None and r.tnr is None


def test_null_prediction_is_an_error_listed_apart(spark):
    r = evaluate(_frame(spark, [(0.0, 0.0), (1.0, None), (1.0, 1.0)])).first()
    assert (r.tn, r.fp, r.fn, r.tp, r.n_null, r.n) == (1, 0, 0, 1, 1, 3)
    assert abs(r.accuracy - 2 / 3) < 1e-12


def test_swapped_orientation(spark):
    r = evaluate(_frame(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), orientation="swapped").first()
    # tn=1 fp=1 fn=2 tp=1 -> NPV = 1/3, PPV = 1/2
    assert abs(r.tnr - 1 / 3) < 1e-12 and abs(r.tpr - 0.5) < 1e-12


def test_metrics_long_one_pass(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 1.0, 1.0), (1.0, 0.0, 0.0)], "label double, a double, b double")
    out = {(r.prep, r.model): r for r in metrics_long(df, {("x", "a"): "a", ("x", "b"): "b"}).collect()}
    assert out[("x", "a")].tp == 1 and out[("x", "a")].fn == 1
    assert out[("x", "b")].fp == 1 and out[("x", "b")].tn == 0


def test_report_lines(spark):
    m = evaluate(_frame(spark, [(0.0, 0.0), (1.0, 1.0)])).selectExpr("'ros' AS prep", "'nb' AS model", "*")
    text = report_lines(m).first()["value"].split("\n")
    assert text[0] == "Precision: 1.0"
    assert text[1].startswith("Confusion Matrix 1.0  0.0")
    assert text[3:] == ["TNR: 1.0", "TPR: 1.0", "Resultado: 1.0"]


def test_metric_sinks_roundtrip(spark):
    import os
    import tempfile

    from counterpoise.sources.sinks import write_metrics, write_reports

    m = evaluate(_frame(spark, [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0)])).selectExpr("'ros' AS prep", "'nb' AS model", "*")
    base = tempfile.mkdtemp(prefix="sinks-")
    for fmt in ("parquet", "json", "csv"):
        write_metrics(m, f"{base}/{fmt}", fmt)
    back = spark.read.parquet(f"{base}/parquet").first()
    assert back.prep == "ros" and back.tp == 1 and back.fn == 1
    assert spark.read.json(f"{base}/json").count() == 1
    write_reports(m, f"{base}/reports")
    assert os.path.isdir(f"{base}/reports/prep=ros/model=nb")
    lines = spark.read.text(f"{base}/reports").collect()
    assert len(lines) == 6 and lines[0].value.startswith("Precision: ")
