"""Keyed (partition-independent) randomness.

``rand(seed)`` depends on partitioning, so it gives different rows after a
repartition or on another cluster size. Every random decision here is a pure
function of (row key, tag, seed) instead: the first 32 bits of an md5 digest,
scaled to [0, 1). The same text expression runs in DuckDB for the oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def keyed_uniform(key, tag, seed: int = 42) -> Column:
    """u(key, tag, seed) in [0, 1)."""
    key_c = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws("|", key_c.cast("string"), _as_col(tag).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def keyed_normal(key, tag, seed: int = 42) -> Column:
    """Standard normal by Box-Muller from two keyed uniforms (1 - u keeps ln finite)."""
    tag_c = _as_col(tag).cast("string")
    u1 = keyed_uniform(key, F.concat(tag_c, F.lit("#a")), seed)
    u2 = keyed_uniform(key, F.concat(tag_c, F.lit("#b")), seed)
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


# DuckDB text of the same functions, used by the oracle SQL.
def u_sql(key: str, tag: str, seed: int = 42) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), CAST({tag} AS VARCHAR), "
            f"'{seed}')), 1, 8))::BIGINT / 4294967296.0)")


def normal_sql(key: str, tag: str, seed: int = 42) -> str:
    u1 = u_sql(key, f"(CAST({tag} AS VARCHAR) || '#a')", seed)
    u2 = u_sql(key, f"(CAST({tag} AS VARCHAR) || '#b')", seed)
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos({2.0 * math.pi!r} * {u2}))"
