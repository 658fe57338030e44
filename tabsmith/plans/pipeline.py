"""Composite plans over the fixtures (flagship and shared stages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators.features import anova_f, interaction_features, ratio_features, top_features
from tabsmith.operators.impute import impute_median
from tabsmith.operators.outliers import winsorize
from tabsmith.sources.fixtures import ORDER_FEATURES, order_features
from tabsmith.session import hold

# Ratio features for the order fixture (same shape as the original preset).
ORDER_RATIOS = [
    ("price_per_line", "sum_price", "n_lines", "ratio"),
    ("qty_per_line", "sum_qty", "n_lines", "ratio"),
    ("price_share", "sum_price", "total_price", "ratio"),
    ("discount_vs_tax", "avg_discount", "avg_tax", "normdiff"),
]


DIGITS = 10  # significant digits that the engines' summing orders leave alone


def sig_round(c, digits: int = DIGITS, zero: float = 0.0):
    """Round a double to ``digits`` significant digits at every magnitude; below ``zero`` in size it becomes 0.

    Sums taken in another order differ in their last bits between engines; this maps both onto one double. It only
    serves the comparison of queries with their oracles: operators return full precision.
    """
    x = c.cast("double")
    out = F.format_string(f"%.{digits - 1}e", x).cast("double") + F.lit(0.0)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(F.abs(x) < zero, F.lit(0.0)).otherwise(out)


def round_doubles(df: DataFrame, cols=(), list_cols=(), zero: float = 0.0, digits: int = DIGITS) -> DataFrame:
    """Apply ``sig_round`` to the named DOUBLE columns and ARRAY<DOUBLE> columns."""
    sel = []
    for f in df.schema.fields:
        if f.name in cols:
            sel.append(sig_round(F.col(f.name), digits, zero).alias(f.name))
        elif f.name in list_cols:
            sel.append(F.transform(f.name, lambda x: sig_round(x, digits, zero)).alias(f.name))
        else:
            sel.append(F.col(f.name))
    return df.select(*sel)


def engineered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_features → median impute → per-class winsorize → ratios + interactions."""
    # Each fitted step reads its input twice (fit, apply): keep the inputs in
    # memory/disk so the joins and decimal sums run once (recomputed from lineage
    # if an executor is lost).
    of = hold(order_features(spark, sf_dir))
    imp = hold(impute_median(of, ORDER_FEATURES))
    win = winsorize(imp, ORDER_FEATURES, by=["class"])
    eng = ratio_features(win, ORDER_RATIOS)
    cols = ORDER_FEATURES + [r[0] for r in ORDER_RATIOS]
    return interaction_features(eng, cols=cols)


def engineered_columns() -> list[str]:
    from tabsmith.operators.features import interaction_names
    cols = ORDER_FEATURES + [r[0] for r in ORDER_RATIOS]
    return cols + [n for n, _, _ in interaction_names(cols)]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANOVA F ranking of the engineered order features (the minimum end-to-end slice)."""
    eng = engineered_orders(spark, sf_dir)
    scores = anova_f(eng, engineered_columns(), "class")
    return top_features(scores, n=len(engineered_columns()))
