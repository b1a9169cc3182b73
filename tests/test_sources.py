"""KEEL and CSV readers (FIXTURES F1, F2), positional index, tables, driver contract."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from counterpoise.operators.index import with_content_id, with_row_index
from counterpoise.sources.tables import FRAMES
from counterpoise.sources.text import parse_keel_header, read_keel, read_labelled_csv

HEADER = """@relation toy
@attribute f0 real [0.0, 1.0]
@attribute f1 real [-2.0, 2.0]
@attribute class {0, 1}
@inputs f0, f1
@outputs class
@data
"""


def _write(text):
    d = tempfile.mkdtemp(prefix="src-")
    p = os.path.join(d, "f.txt")
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_keel_header_and_scaled_row(spark):
    h = parse_keel_header(HEADER.splitlines())
    assert h.num_classes == 2 and h.inputs == ["f0", "f1"]
    good, bad, _ = read_keel(spark, _write(HEADER), _write("0.5,0.0,1\n"), scale=True)
    r = good.first()
    assert r.features == [0.5, 0.5] and r.label == 1.0 and r.id is not None
    assert bad.count() == 0


def test_keel_types_and_bad_rows(spark):
    header = """@relation t
@attribute class {no, yes}
@attribute n integer [1, 9]
@attribute colour {red, green, blue}
@attribute flat real [3.0, 3.0]
@inputs n, colour, flat
@outputs class
@data
yes, 5, blue, 3.0
no,9,red,3.0
maybe,1,red,3.0
yes,x,red,3.0
no,1,red
"""
    path = _write(header)
    good, bad, h = read_keel(spark, path)
    rows = sorted((r.label, r.features) for r in good.collect())
    assert rows == [(0.0, [1.0, 0.0, 0.0]), (1.0, [0.5, 2.0, 0.0])]
    assert bad.count() == 3 and h.num_classes == 2


def test_labelled_csv_bad_rows(spark):
    text = "0.91,0.12,-1.30,1\n0.33,0.80,0.25,0\n5\n0.1,1\n0.1,0.2,0.3,0.4,1\n0.1,abc,0.2,1\n0.2,0.3,0.4,2\n\n"
    good, bad = read_labelled_csv(spark, _write(text), num_fields=4)
    assert sorted((r.label, r.features) for r in good.collect()) == [(0.0, [0.33, 0.8, 0.25]), (1.0, [0.91, 0.12, -1.3])]
    # too few fields (twice), too many, a non-number, label 2; the empty line is skipped
    assert bad.count() == 5


def test_row_index_consecutive(spark):
    df = with_row_index(spark.range(1000).repartition(7))
    r = df.agg(F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first()
    assert tuple(r) == (0, 999, 1000)


def test_row_index_after_aggregate_with_coalescing(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        df = spark.range(40000).withColumn("v", F.col("id") * 3).groupBy("id").agg(F.max("v").alias("v"))
        r = with_row_index(df).agg(F.count("*"), F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first()
        assert tuple(r) == (40000, 0, 39999, 40000)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_content_id_is_unique_and_partition_free(spark):
    lines = spark.createDataFrame([(f"row {i % 50}",) for i in range(300)], "value string")
    a = with_content_id(lines.repartition(2))
    b = with_content_id(lines.repartition(9))
    assert a.count() == 300 and a.select("id").distinct().count() == 300
    assert a.exceptAll(b).count() == 0
    assert with_content_id(lines.limit(0)).count() == 0


def test_keel_header_without_range_round_trips(spark):
    h = parse_keel_header(["@relation t", "@attribute f real", "@attribute class {0, 1}", "@data"])
    again = parse_keel_header(h.lines())
    assert again.attribute("f").lo is None and again.num_classes == 2


@pytest.mark.parametrize("name", sorted(FRAMES))
def test_frames_contract(spark, name):
    df = FRAMES[name](spark, SF01)
    assert df.columns[:3] == ["id", "label", "features"]
    assert df.count() == df.select("id").distinct().count()
    assert df.where(~F.col("label").isin(0.0, 1.0)).count() == 0


def test_driver_contract(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() == 1 and {"tnr", "tpr", "product"} <= set(out.columns)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30
    assert os.path.isdir(SF001)


def test_experiment_on_keel_files(spark):
    """An original-style run: KEEL header + train + test text files -> metrics and reports."""
    from counterpoise.frame import split
    from counterpoise.operators.scaling import MinMaxScaler
    from counterpoise.plans.experiment import run_experiment
    from counterpoise.plans.grid import GridParams
    from counterpoise.sources.text import header_for, write_keel

    train, test = split(FRAMES["orders"](spark, SF001))
    fitted = MinMaxScaler().fit(train)
    header = header_for([f"f{j}" for j in range(5)], list(zip(fitted.lo, fitted.hi)), "orders")
    base = tempfile.mkdtemp(prefix="exp-")
    write_keel(train, header, f"{base}/train")
    write_keel(test, header, f"{base}/test")
    params = GridParams(rf_trees=3, pcard_trees=3, pcard_depth=3, dt_depth=4)
    m = run_experiment(spark, f"{base}/train/header", f"{base}/train/data", f"{base}/test/data",
                       preps=("none", "ros", "rus"), models=("dt", "rf", "pcard", "nb"), params=params,
                       out=f"{base}/out")
    rows = m.collect()
    assert len(rows) == 12 and all(r.n == test.count() for r in rows)
    assert spark.read.parquet(f"{base}/out/metrics").count() == 12
    assert spark.read.text(f"{base}/out/reports").count() == 72
