"""The preprocessing x model grid over every preprocessing chain (E10, B6-B8)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from counterpoise.frame import split
from counterpoise.plans.grid import MODELS, PREPS, GridParams, run_grid
from counterpoise.sources.tables import lp_emb


def grid_frames(spark):
    return split(lp_emb(spark, SF01))


def small():
    return GridParams(dt_depth=4, rf_trees=3, rf_trees_ros180=3, rf_depth=4, pcard_trees=3, pcard_depth=3,
                      hme_trees=3, hme_depth=4, fcnn_max_rows=200, prep_parallelism=4, partitions=4)


def test_grid_all_preps_and_models(spark):
    train, test = grid_frames(spark)
    p = small()
    preps = tuple(sorted(PREPS))
    m = run_grid(train, test, preps=preps, models=MODELS, params=p).cache()
    n_test = test.count()
    assert m.count() == len(preps) * len(MODELS)
    bad = m.where((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp") + F.col("n_null") != F.col("n"))
                  | (F.col("n") != n_test) | (F.col("n_null") != 0))
    assert bad.count() == 0
    rates = {r.prep: r.rate for r in m.select("prep", "rate").distinct().collect()}
    assert rates["ros_180"] == 1.8 and rates["ros_fcnn"] == 1.8 and rates["fcnn_ros"] == 1.0 and rates["none"] is None
    # rates stay in [0, 1]
    assert m.where((F.col("tnr") < 0) | (F.col("tnr") > 1) | (F.col("tpr") < 0) | (F.col("tpr") > 1)).count() == 0


def test_a_broken_grid_does_only_the_rest(spark, tmp_path, monkeypatch):
    from counterpoise.plans import grid

    train, test = grid_frames(spark)
    whole = run_grid(train, test, preps=("none", "ros", "rus"), models=("dt", "nb"), params=small())
    ran = []
    fit = grid.fit_model

    def counted(name, frame, prep, p, scaler=None):
        ran.append((prep, name))
        if len(ran) == 4:
            raise RuntimeError("lost")
        return fit(name, frame, prep, p, scaler)

    monkeypatch.setattr(grid, "fit_model", counted)
    ledger = str(tmp_path / "cells")
    with pytest.raises(RuntimeError):
        run_grid(train, test, preps=("none", "ros", "rus"), models=("dt", "nb"), params=small(), ledger=ledger)
    before = len(ran)
    resumed = run_grid(train, test, preps=("none", "ros", "rus"), models=("dt", "nb"), params=small(), ledger=ledger)
    assert {p for p, _ in ran[before:]} == {"ros", "rus"} and len(ran) - before == 4
    assert sorted(map(tuple, resumed.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    done = len(ran)
    assert run_grid(train, test, preps=("rus",), models=("nb",), params=small(), ledger=ledger).count() == 1 and len(ran) == done
    other = small()
    other.nb_smoothing = 2.0  # other settings: other cells
    assert run_grid(train, test, preps=("rus",), models=("nb",), params=other, ledger=ledger).count() == 1 and len(ran) == done + 1
