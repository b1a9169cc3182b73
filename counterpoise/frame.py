"""The labelled-frame contract.

A labelled frame has ``id`` (unique, not null), ``label`` (double, 0.0/1.0) and
``features`` (``array<double>``).  Operators may add ``copy_no`` (ROS), ``weight``
(ROS as weights), ``fold`` (HME) and ``prediction`` (scoring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterpoise.functions.hashing import hash_uniform

ID = "id"
LABEL = "label"
FEATURES = "features"
BINARY = (0.0, 1.0)


def labelled(df: DataFrame, id_col: str = ID, label_col: str = LABEL, features_col: str = FEATURES) -> DataFrame:
    """Project any frame onto the contract (renames, casts the label, keeps the rest)."""
    return df.select(
        F.col(id_col).alias(ID),
        F.col(label_col).cast("double").alias(LABEL),
        F.transform(F.col(features_col), lambda x: x.cast("double")).alias(FEATURES, metadata=df.schema[features_col].metadata),
        *[c for c in df.columns if c not in (id_col, label_col, features_col)],
    )


DIM_KEY = "num_features"


def with_dim(c: Column, d: int, name: str = FEATURES) -> Column:
    """Alias a feature-array column and record its length in the column metadata."""
    return c.alias(name, metadata={DIM_KEY: int(d)})


def num_features(df: DataFrame, features_col: str = FEATURES) -> int:
    """Length of the feature arrays: from the column metadata when the frame
    builder recorded it, else read from one row."""
    meta = df.schema[features_col].metadata or {}
    if DIM_KEY in meta:
        return int(meta[DIM_KEY])
    row = df.select(F.size(features_col).alias("d")).where(F.col("d") >= 0).limit(1).collect()
    if not row:
        raise ValueError("cannot read the feature length of an empty frame")
    return int(row[0]["d"])


def class_counts_map(df: DataFrame, label_col: str = LABEL, weight_col: str | None = None) -> dict:
    """``{0.0: n_neg, 1.0: n_pos, "other": n_foreign}`` from ONE global aggregation
    (one row reaches the driver, however many distinct labels there are)."""
    y = F.col(label_col)
    w = F.col(weight_col) if weight_col else F.lit(1)
    r = df.agg(
        F.sum(F.when(y == 0.0, w).otherwise(0)).alias("n0"),
        F.sum(F.when(y == 1.0, w).otherwise(0)).alias("n1"),
        F.sum(F.when(~F.coalesce(y.isin(*BINARY), F.lit(False)), w).otherwise(0)).alias("nx"),
    ).first()
    return {0.0: r["n0"] or 0, 1.0: r["n1"] or 0, "other": r["nx"] or 0}


def check_binary(counts: dict, strict: bool = True) -> tuple[int, int]:
    """Return ``(n_neg, n_pos)``; raise on foreign labels (or ignore them when not strict)."""
    if counts.get("other", 0) and strict:
        raise ValueError(f"{counts['other']} rows have labels outside {{0, 1}} (use strict=False to drop them)")
    return int(counts.get(0.0, 0)), int(counts.get(1.0, 0))


def binary_only(df: DataFrame, label_col: str = LABEL) -> Column:
    return F.col(label_col).isin(*BINARY)


def split(df: DataFrame, train_fraction: float = 0.7, seed: int = 7, id_col: str = ID) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by ``hash_uniform(id, seed) < train_fraction``."""
    u = hash_uniform(id_col, seed)
    return df.where(u < F.lit(train_fraction)), df.where(u >= F.lit(train_fraction))
