"""Deterministic randomness: a uniform draw per (seed, row id).

``hash_uniform(id, seed)`` reads the first 32 bits of ``md5("<seed>:<id>")`` as
an unsigned integer and divides by 2**32.  The draw depends only on the id
and the seed, never on the partitioning, the task attempt or the executor, so
a lost executor recomputes exactly the same sample and the same rows can be
re-derived in plain SQL (DuckDB: ``('0x'||substr(md5(seed||':'||id),1,8))::BIGINT
/ 4294967296.0``).

Poisson draws (sampling with replacement) use the inverse CDF on the same
uniform: the number of copies is the count of CDF values ``<= u``.  The CDF is
a parameter-sized constant (it depends on the rate only), built on the driver
and inlined as a balanced CASE tree, so the per-row cost is ~log2(len) codegen'd
comparisons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from counterpoise.functions.literals import sql_double, sql_ident

TWO_POW_32 = 4294967296.0
# Largest value hash_uniform can take.
_U_MAX = 1.0 - 1.0 / TWO_POW_32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(id_col, seed) -> Column:
    """Uniform double in [0, 1) from md5 of ``"<seed>:<id>"``."""
    key = F.concat(F.lit(f"{seed}:"), _col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def hash_bucket(id_col, seed, n: int) -> Column:
    """Bucket in ``0 .. n-1``: ``floor(hash_uniform * n)`` (uniform, partition-free)."""
    return F.floor(hash_uniform(id_col, seed) * F.lit(float(n))).cast("int")


def poisson_cdf(lam: float) -> tuple[int, list[float]]:
    """Window ``(lo, [CDF(lo), CDF(lo+1), ...])`` of the Poisson(lam) CDF.

    The window spans ``lam ± (10*sqrt(lam) + 20)``; outside it the mass is far
    below one ulp of a double.  Terms are computed in log space so large rates
    do not underflow.
    """
    if not (lam > 0 and math.isfinite(lam)):
        raise ValueError(f"Poisson rate must be positive and finite, got {lam}")
    spread = 10.0 * math.sqrt(lam) + 20.0
    lo = max(0, int(math.floor(lam - spread)))
    hi = int(math.ceil(lam + spread))
    log_lam = math.log(lam)
    total = 0.0
    cdf = []
    for k in range(lo, hi + 1):
        total += math.exp(-lam + k * log_lam - math.lgamma(k + 1))
        cdf.append(total)
        if total > _U_MAX:
            break  # no draw can reach past this entry
    return lo, cdf


def _first_above(u: str, cdf: list[float], lo: int, hi: int) -> str:
    # SQL for the smallest i in [lo, hi] with cdf[i] > u (hi == len(cdf) means none)
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    return (
        f"CASE WHEN {u} < {sql_double(cdf[mid])} THEN {_first_above(u, cdf, lo, mid)} "
        f"ELSE {_first_above(u, cdf, mid + 1, hi)} END"
    )


def poisson_copies(u: str, lam: float) -> Column:
    """Poisson(lam) draw from the uniform column named ``u``: ``#{k : CDF(k) <= u}``."""
    lo, cdf = poisson_cdf(lam)
    ref = sql_ident(u)
    return F.expr(f"CAST({lo} + {_first_above(ref, cdf, 0, len(cdf))} AS INT)")
