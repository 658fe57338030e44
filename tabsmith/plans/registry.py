"""Query registry: name → Spark callable (spark, sf_dir) and name → DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabsmith.plans.pipeline import DIGITS, round_doubles
from tabsmith.session import held_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RAW_SQL: dict[str, str] = {}  # oracle text before output rounding (for composing queries)


def rounded_sql(sql: str, doubles: tuple = (), double_lists: tuple = (), zero: float = 0.0,
                digits: int = DIGITS) -> str:
    """Wrap oracle SQL so DOUBLE outputs are rounded like ``round_doubles``."""
    fix = f"(CASE WHEN abs({{x}}) < {zero!r} THEN 0.0 ELSE CAST(printf('%.{digits - 1}e', {{x}}) AS DOUBLE) + 0.0 END)"
    reps = [f"{fix.format(x=c)} AS {c}" for c in doubles]
    reps += [f"list_transform({c}, lambda x: {fix.format(x='x')}) AS {c}" for c in double_lists]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM (\n{sql}\n) _q"


def query(name: str, sql: str | None = None, doubles: tuple = (), double_lists: tuple = (), zero: float = 0.0,
          digits: int = DIGITS):
    """Register a query; ``zero`` and fewer ``digits`` are for differences of larger numbers, see ``sig_round``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return held_with(lambda: round_doubles(fn(spark, sf_dir), doubles, double_lists, zero, digits))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            RAW_SQL[name] = sql
            ORACLES[name] = rounded_sql(sql, doubles, double_lists, zero, digits)
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from tabsmith.plans import q_charts, q_eval, q_models, q_prep  # noqa: F401
