"""ROS / RUS properties."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF01, labelled_rows
from counterpoise.functions.hashing import hash_uniform, poisson_cdf, poisson_copies
from counterpoise.operators import balance
from counterpoise.sources.tables import lp_quality, lp_toxic


def _counts(df):
    return {r["label"]: r["n"] for r in balance.class_counts(df).collect()}


def _toy(spark, n_neg, n_pos, extra=()):
    rows = [(i, 0.0, [float(i)]) for i in range(n_neg)] + [(1000 + i, 1.0, [float(i)]) for i in range(n_pos)]
    return labelled_rows(spark, rows + list(extra))


def test_ros_negative_majority(spark):
    df = _toy(spark, 90, 10)
    out = balance.ros(df, 1.0, seed=3)
    c = _counts(out)
    assert c[0.0] == 90
    assert abs(c[1.0] - 90) < 5 * math.sqrt(90)
    # majority untouched, only minority ids repeated
    maj = out.where("label = 0")
    assert maj.count() == maj.select("id").distinct().count() == 90
    assert out.where("label = 1").agg(F.max("copy_no")).first()[0] >= 2


def test_ros_positive_majority_and_tie(spark):
    c = _counts(balance.ros(_toy(spark, 10, 90), 1.0, seed=3))
    assert c[1.0] == 90 and abs(c[0.0] - 90) < 5 * math.sqrt(90)
    # tie: the positives are resampled with lambda = rate
    tie = balance.ros_copies(_toy(spark, 50, 50), 1.0, seed=3)
    assert tie.where("label = 0").agg(F.min("copies"), F.max("copies")).first() == (1, 1)
    assert tie.where("label = 1").agg(F.max("copies")).first()[0] > 1


@pytest.mark.parametrize("rate", [1.0, 1.15, 1.4, 1.5, 1.8])
def test_ros_rates_expected_size(spark, rate):
    df = lp_toxic(spark, SF01)
    c = _counts(balance.ros(df, rate, seed=11))
    assert c[0.0] == 348
    expected = 348 * rate
    assert abs(c[1.0] - expected) < 5 * math.sqrt(expected)


def test_ros_weights_equal_copies(spark):
    df = lp_quality(spark, SF01)
    w = balance.ros(df, 1.4, seed=5, as_weights=True).groupBy("label").agg(F.sum("weight").alias("n"))
    e = balance.class_counts(balance.ros(df, 1.4, seed=5))
    assert {r.label: r.n for r in w.collect()} == {r.label: float(r.n) for r in e.collect()}


def test_empty_class_and_foreign_labels(spark):
    with pytest.raises(ValueError):
        balance.ros(_toy(spark, 100, 0), 1.0)
    foreign = _toy(spark, 20, 5, extra=[(9999, 2.0, [0.0])])
    with pytest.raises(ValueError):
        balance.ros(foreign, 1.0)
    out = balance.ros(foreign, 1.0, strict=False)
    assert out.where("label = 2").count() == 0
    with pytest.raises(ValueError):
        balance.rus(foreign)


def test_rus(spark):
    df = _toy(spark, 90, 10)
    out = balance.rus(df, seed=4)
    c = _counts(out)
    assert c[1.0] == 10 and c[0.0] <= 90
    assert abs(c[0.0] - 10) < 5 * math.sqrt(10) + 3
    # subset of the input, minority untouched
    assert out.join(df, ["id", "label"], "left_anti").count() == 0
    assert _counts(balance.rus(_toy(spark, 50, 50)))[0.0] == 50  # tie keeps everything


def test_same_result_on_2_and_7_partitions(spark):
    df = lp_toxic(spark, SF01).cache()
    a = balance.ros(df.repartition(2), 1.5, seed=9).select("id", "copy_no")
    b = balance.ros(df.repartition(7), 1.5, seed=9).select("id", "copy_no")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    r2 = balance.rus(df.repartition(2), seed=9).select("id")
    r7 = balance.rus(df.repartition(7), seed=9).select("id")
    assert r2.exceptAll(r7).count() == 0 and r7.exceptAll(r2).count() == 0


def test_poisson_cdf_and_large_rate(spark):
    lo, cdf = poisson_cdf(4.0)
    assert lo == 0 and cdf[-1] > 1 - 2**-32 and all(a <= b for a, b in zip(cdf, cdf[1:]))
    lo, cdf = poisson_cdf(5000.0)
    assert lo > 0 and len(cdf) > 256
    df = spark.range(4000).withColumn("_u", hash_uniform("id", 1))
    mean = df.select(poisson_copies("_u", 5000.0).alias("c")).agg(F.avg("c")).first()[0]
    assert abs(mean - 5000) < 10
    small = df.select(poisson_copies("_u", 3.0).alias("c")).agg(F.avg("c"), F.variance("c")).first()
    assert abs(small[0] - 3) < 0.2 and abs(small[1] - 3) < 0.4


def test_rate_sweep_matches_individual_runs(spark):
    df = lp_toxic(spark, SF01)
    sweep = {(r.rate, r.label): r.n for r in balance.rate_sweep(df, (1.0, 1.8), seed=2).collect()}
    for rate in (1.0, 1.8):
        c = _counts(balance.ros(df, rate, seed=2))
        assert sweep[(rate, 1.0)] == c[1.0] and sweep[(rate, 0.0)] == c[0.0]


def test_ros_spreads_the_copies(spark):
    rows = [(i, 0.0, [float(i)]) for i in range(20000)] + [(20000 + i, 1.0, [float(i)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, label double, features array<double>").repartitionByRange(8, "label", "id")
    out = balance.ros(df, 1.0, seed=1, repartition=8)
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    same = balance.ros(df, 1.0, seed=1, repartition=False).select("id", "copy_no")
    assert out.select("id", "copy_no").exceptAll(same).count() == 0


def test_ros_refuses_oversampled_input(spark):
    once = balance.ros(_toy(spark, 30, 5), 1.0, seed=1)
    with pytest.raises(ValueError):
        balance.ros(once, 1.0)
