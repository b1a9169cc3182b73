"""Hash draws and Poisson copies against plain-Python computations (property tests)."""

import hashlib
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from counterpoise.functions.hashing import hash_bucket, hash_uniform, poisson_cdf, poisson_copies
from counterpoise.operators.noise import assign_folds


def py_uniform(i, seed):
    return int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16) / 2**32


def py_poisson(u, lam):
    k, p = 0, math.exp(-lam)
    c = p
    while c <= u:
        k += 1
        p *= lam / k
        c += p
    return k


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10**6), lam=st.floats(0.05, 40.0))
def test_draws_match_python(spark, seed, lam):
    ids = list(range(0, 3000, 7))
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("_u", hash_uniform("id", seed))
    got = df.select("id", "_u", poisson_copies("_u", lam).alias("c"), hash_bucket("id", seed, 5).alias("b")).collect()
    for r in got:
        u = py_uniform(r.id, seed)
        assert r._u == u
        assert r.b == math.floor(u * 5)
        assert r.c == py_poisson(u, lam) or abs(_cdf_gap(u, lam)) < 1e-12


def _cdf_gap(u, lam):
    lo, cdf = poisson_cdf(lam)
    return min(abs(c - u) for c in cdf)


def test_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "id")
    a = assign_folds(df.repartition(2), 4, 9).select("id", "fold")
    b = assign_folds(df.repartition(7), 4, 9).select("id", "fold")
    assert a.exceptAll(b).count() == 0
    sizes = [r["count"] for r in a.groupBy("fold").count().collect()]
    assert len(sizes) == 4 and min(sizes) > 80
