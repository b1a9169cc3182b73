"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from counterpoise.functions.hashing import hash_uniform, hash_bucket, poisson_cdf, poisson_copies  # noqa: F401
from counterpoise.functions.vectors import (  # noqa: F401
    squared_distance,
    dot_literal,
    to_vector,
)
