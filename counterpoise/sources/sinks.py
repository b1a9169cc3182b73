"""Metric sinks: the metrics table (Parquet/CSV/JSON, partitioned by prep) and
the classic six-line text report per (prep, model).

Overwriting replaces only the preps that are written (dynamic partition overwrite): reports
of several preps stand side by side, and a repeated write replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from counterpoise.operators.evaluate import report_lines


def write_metrics(metrics: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    w = metrics.write.mode(mode)
    if "prep" in metrics.columns:
        w = w.partitionBy("prep").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        getattr(w, fmt)(path)


def write_reports(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text file per (prep, model) holding the six report lines."""
    keys = [c for c in ("prep", "model") if c in metrics.columns]
    w = report_lines(metrics).write.mode(mode)
    (w.partitionBy(*keys).option("partitionOverwriteMode", "dynamic") if keys else w).text(path)
