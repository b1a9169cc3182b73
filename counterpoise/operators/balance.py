"""Rebalancing: class counts, random oversampling (ROS), random undersampling (RUS).

Semantics follow the classic RDD version (one count per class, then a union of
the majority with a sampled minority), rewritten as one aggregation plus one
narrow, single-pass projection:

* class counts come from one partial/final aggregation (two rows reach the driver);
* ROS gives every minority row ``Poisson(lam)`` copies drawn from
  ``hash_uniform(id, seed)`` (``lam = |majority| * rate / |minority|``), majority rows
  one copy; rows drawing 0 copies vanish, the rest are exploded with ``copy_no``
  and dealt out by ``(id, copy_no)``;
* ``as_weights=True`` keeps one row per id with ``weight = copies`` instead of
  physical copies (DT, RF and NB all accept a weight column);
* RUS keeps the minority and majority rows with ``hash_uniform < |minority|/|majority|``.

The minority is the positive class unless the positives strictly outnumber the
negatives (a tie oversamples the positives).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import ID, LABEL, binary_only, check_binary, class_counts_map
from counterpoise.functions.hashing import hash_uniform, poisson_copies

COPY_NO = "copy_no"
WEIGHT = "weight"

# Rates of the published oversampling experiments (fixed values).
PUBLISHED_RATES = (1.0, 1.15, 1.4, 1.5, 1.8)


def class_counts(df: DataFrame, label_col: str = LABEL) -> DataFrame:
    """``(label, n)`` — one aggregation with map-side partial counts."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def class_fractions(df: DataFrame, label_col: str = LABEL) -> DataFrame:
    """One row: ``n_neg, n_pos, n, minority, imbalance_ratio`` in a single pass."""
    lab = F.col(label_col)
    c = df.agg(
        F.count_if(lab == 0.0).alias("n_neg"),
        F.count_if(lab == 1.0).alias("n_pos"),
        F.count(F.lit(1)).alias("n"),
    )
    return c.select(
        "n_neg",
        "n_pos",
        "n",
        F.when(F.col("n_pos") > F.col("n_neg"), F.lit(0.0)).otherwise(F.lit(1.0)).alias("minority"),
        F.try_divide(F.greatest("n_neg", "n_pos").cast("double"), F.least("n_neg", "n_pos").cast("double")).alias(
            "imbalance_ratio"
        ),
    )


def sides(counts: dict, strict: bool = True) -> tuple[float, int, int]:
    """``(minority_label, n_minority, n_majority)``; raises when a class is empty."""
    n_neg, n_pos = check_binary(counts, strict)
    if n_neg == 0 or n_pos == 0:
        raise ValueError(f"both classes are needed to rebalance (negatives={n_neg}, positives={n_pos})")
    if n_pos > n_neg:
        return 0.0, n_neg, n_pos
    return 1.0, n_pos, n_neg


def ros_rate(counts: dict, rate: float, strict: bool = True) -> tuple[float, float]:
    """``(minority_label, lam)`` with ``lam = |majority| * rate / |minority|``."""
    if rate <= 0:
        raise ValueError("rate must be positive")
    minority, n_min, n_maj = sides(counts, strict)
    return minority, n_maj * rate / n_min


def ros_copies(
    df: DataFrame,
    rate: float = 1.0,
    seed: int = 1,
    strict: bool = True,
    label_col: str = LABEL,
    id_col: str = ID,
    counts: dict | None = None,
) -> DataFrame:
    """The input (binary labels only) plus ``copies``: how many times ROS emits each row."""
    counts = counts if counts is not None else class_counts_map(df, label_col)
    minority, lam = ros_rate(counts, rate, strict)
    # the draw is materialised once per row, then searched by the CASE tree
    u = df.where(binary_only(df, label_col)).withColumn("_u", hash_uniform(id_col, seed))
    copies = F.when(F.col(label_col) == F.lit(minority), poisson_copies("_u", lam)).otherwise(F.lit(1))
    return u.withColumn("copies", copies).drop("_u")


def ros(
    df: DataFrame,
    rate: float = 1.0,
    seed: int = 1,
    strict: bool = True,
    as_weights: bool = False,
    label_col: str = LABEL,
    id_col: str = ID,
    counts: dict | None = None,
    repartition: int | bool = True,
) -> DataFrame:
    """Random oversampling with replacement of the minority class.

    Returns the rows with ``copy_no`` (1..copies), or with ``weight`` when
    ``as_weights``.  Expected minority size = ``|majority| * rate``.

    The copies are dealt out by a hash of ``(id, copy_no)``, so a partition that held
    most of the minority does not keep all its copies (``repartition=n`` fixes the number
    of partitions; ``False`` leaves the copies where their row is).  ``as_weights`` makes
    no copies and needs no shuffle.
    """
    if COPY_NO in df.columns or WEIGHT in df.columns:
        raise ValueError("input is already oversampled (has copy_no/weight); oversample the original rows once")
    c = ros_copies(df, rate, seed, strict, label_col, id_col, counts)
    if as_weights:
        out = c.where(F.col("copies") > 0).withColumn(WEIGHT, F.col("copies").cast("double")).drop("copies")
    else:
        # Rows drawing 0 copies explode to nothing.  (sequence(1, 0) would count
        # down to [1, 0], hence the empty-array branch; a separate copies > 0
        # filter would be pushed below the scan and evaluate the draw twice.)
        seq = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<int>"))
        out = c.withColumn(COPY_NO, F.explode(seq)).drop("copies")
        if repartition is True:
            out = out.repartition(id_col, COPY_NO)
        elif repartition:
            out = out.repartition(int(repartition), id_col, COPY_NO)
    return out


def rus(
    df: DataFrame,
    seed: int = 1,
    strict: bool = True,
    label_col: str = LABEL,
    id_col: str = ID,
    counts: dict | None = None,
) -> DataFrame:
    """Random undersampling without replacement of the majority class (Bernoulli by hash)."""
    counts = counts if counts is not None else class_counts_map(df, label_col)
    minority, n_min, n_maj = sides(counts, strict)
    majority = 1.0 - minority
    fraction = n_min / n_maj
    keep = (F.col(label_col) != F.lit(majority)) | (hash_uniform(id_col, seed) < F.lit(fraction))
    return df.where(binary_only(df, label_col) & keep)


def rate_sweep(
    df: DataFrame,
    rates=PUBLISHED_RATES,
    seed: int = 1,
    strict: bool = True,
    label_col: str = LABEL,
    id_col: str = ID,
) -> DataFrame:
    """Class sizes after ROS at every rate, from ONE scan: ``(rate, label, n, expected)``.

    Each rate is one extra ``copies`` expression on the same row; one
    aggregation sums them all, then a stack turns the result long.
    """
    counts = class_counts_map(df, label_col)
    aggs, stack_args = [], []
    for i, r in enumerate(rates):
        minority, lam = ros_rate(counts, r, strict)
        _, n_min, n_maj = sides(counts, strict)
        copies = F.when(F.col(label_col) == F.lit(minority), poisson_copies("_u", lam)).otherwise(F.lit(1))
        aggs.append(F.sum(copies).cast("long").alias(f"n_{i}"))
        stack_args.append((float(r), f"n_{i}", n_maj * float(r), float(n_maj)))
    drawn = df.where(binary_only(df, label_col)).withColumn("_u", hash_uniform(id_col, seed))
    per_label = drawn.groupBy(label_col).agg(*aggs)
    minority, _, _ = sides(counts, strict)
    n = len(stack_args)
    expr = ", ".join(f"CAST({r!r} AS DOUBLE), {c}" for r, c, _, _ in stack_args)
    long = per_label.selectExpr(label_col, f"stack({n}, {expr}) AS (rate, n)")
    exp_min = {r: e for r, _, e, _ in stack_args}
    exp_maj = {r: m for r, _, _, m in stack_args}
    expected = F.lit(None).cast("double")
    for r in exp_min:
        expected = F.when(
            F.col("rate") == F.lit(r),
            F.when(F.col(label_col) == F.lit(minority), F.lit(exp_min[r])).otherwise(F.lit(exp_maj[r])),
        ).otherwise(expected)
    return long.select("rate", label_col, "n", expected.alias("expected"))
