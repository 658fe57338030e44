"""Small generators of DuckDB text for the oracle side (lists of columns, maps)."""

from __future__ import annotations

from tabsmith.functions.parse import NUMERIC_PATTERN
from tabsmith.functions.presets import variant_map

STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def label_sql(x: str, canonical: list[str]) -> str:
    s = strip(x)
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in variant_map(canonical))
    return f"coalesce(CASE {s} {whens} END, {s})"


def valid_sql(lbl: str, canonical: list[str]) -> str:
    return f"coalesce({lbl} IN ({', '.join(repr(c) for c in canonical)}), false)"


def safe_double_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMERIC_PATTERN}') THEN TRY_CAST({x} AS DOUBLE) END"


def suffix_sql(x: str, suffix: str = " cm") -> str:
    return safe_double_sql(strip(f"replace({x}, '{suffix}', '')"))


def null_token_sql(x: str) -> str:
    return f"CASE WHEN {x} IN ('?', '') THEN NULL ELSE {x} END"


def unpivot(table: str, cols: list[str], keep: list[str]) -> str:
    """Long form (keep..., feature, value) with NULL values dropped."""
    parts = [f"SELECT {', '.join(keep + [repr(c) + ' AS feature', c + ' AS value'])} FROM {table} "
             f"WHERE {c} IS NOT NULL" for c in cols]
    return "\nUNION ALL ".join(parts)


def clip_sql(c: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END"
