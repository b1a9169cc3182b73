"""SQL text for literal-heavy expressions.

Expressions with hundreds of constants (cut tables, model weights, CDFs) are
written as ONE SQL string and parsed by ``F.expr`` — one call into the JVM
instead of one per ``F.lit``.  Catalyst folds the constants as usual.
"""

from __future__ import annotations

import math


def sql_double(v: float) -> str:
    v = float(v)
    if math.isnan(v):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(v):
        return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{v!r}D"


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
