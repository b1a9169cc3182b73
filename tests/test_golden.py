"""E1-E9 against the 36 published result files."""

import pytest
from pyspark.sql import functions as F

from counterpoise.operators.evaluate import confusion, rates
from golden_values import GOLDEN

SWAPPED = {"dt", "rf"}


def _weighted_pairs(spark):
    rows = []
    for prep, model, m00, m01, m10, m11, *_ in GOLDEN:
        if model in SWAPPED:  # printed rows are predictions, columns labels
            cells = {(0, 0): m00, (0, 1): m10, (1, 0): m01, (1, 1): m11}
        else:  # printed rows are labels, columns predictions
            cells = {(0, 0): m00, (0, 1): m01, (1, 0): m10, (1, 1): m11}
        for (y, p), n in cells.items():
            rows.append((prep, model, float(y), float(p), int(n)))
    return spark.createDataFrame(rows, "prep string, model string, label double, prediction double, n long")


@pytest.fixture(scope="module")
def metrics(spark):
    cm = confusion(_weighted_pairs(spark), by=["prep", "model"], weight_col="n")
    true = rates(cm).select("prep", "model", "tn", "fp", "fn", "tp", "n", "accuracy", "tnr", "tpr", "product")
    swapped = rates(cm, "swapped").select(
        "prep", "model", F.col("tnr").alias("s_tnr"), F.col("tpr").alias("s_tpr"), F.col("product").alias("s_product")
    )
    return {(r["prep"], r["model"]): r for r in true.join(swapped, ["prep", "model"]).collect()}


def test_every_file_reproduced(metrics):
    assert len(metrics) == 36
    for prep, model, *_, acc, tnr, tpr, res in GOLDEN:
        r = metrics[(prep, model)]
        assert r["n"] == 999404
        assert r["accuracy"] == pytest.approx(acc, abs=1e-9)
        got_tnr, got_tpr = (r["s_tnr"], r["s_tpr"]) if model in SWAPPED else (r["tnr"], r["tpr"])
        assert got_tnr == pytest.approx(tnr, abs=1e-9), (prep, model)
        assert got_tpr == pytest.approx(tpr, abs=1e-9), (prep, model)


def test_products_and_the_bayes_defect(metrics):
    """Resultado = TNR*TPR in 28 files; the 8 NB files outside NoPrepro print PCARD's product."""
    own = 0
    for prep, model, *_, res in GOLDEN:
        r = metrics[(prep, model)]
        mine = r["s_product"] if model in SWAPPED else r["product"]
        if model == "bayes" and prep != "NoPrepro":
            assert res == pytest.approx(metrics[(prep, "pcard")]["product"], abs=1e-9)
            continue
        assert mine == pytest.approx(res, abs=1e-9), (prep, model)
        own += 1
    assert own == 28


def test_true_orientation_best_model(metrics):
    best = max(metrics.values(), key=lambda r: r["product"])
    assert (best["prep"], best["model"]) == ("ROS100", "rf")
    assert best["product"] == pytest.approx(0.5037, abs=1e-4)
    # every test matrix has 470596 negatives and 528808 positives
    for r in metrics.values():
        assert r["tn"] + r["fp"] == 470596 and r["fn"] + r["tp"] == 528808
