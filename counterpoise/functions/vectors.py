"""Feature-vector helpers.  Features travel as ``array<double>`` (SQL-checkable)
and become ``VectorUDT`` only at the boundary of ``pyspark.ml`` estimators."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

from counterpoise.functions.literals import sql_double, sql_ident


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_vector(c) -> Column:
    """``array<double>`` -> dense ``VectorUDT`` (JVM-side)."""
    return array_to_vector(_col(c))


def dot_literal(c: str, weights: list[float], bias: float = 0.0) -> Column:
    """``bias + sum_j c[j] * weights[j]`` with the weights inlined (one codegen'd sum)."""
    ref = sql_ident(c)
    terms = " + ".join(f"{ref}[{j}] * {sql_double(w)}" for j, w in enumerate(weights))
    return F.expr(f"{sql_double(bias)} + {terms}" if terms else sql_double(bias))


def squared_distance(a, b) -> Column:
    """Squared Euclidean distance between two equally long arrays."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
