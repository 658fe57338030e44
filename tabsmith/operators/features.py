"""Feature engineering and selection (F1-F8)."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.presets import INTERACTION_TOP_N, K_BEST, RATIO_EPS, TOP_LOG
from tabsmith.operators.clean import numeric_columns
from tabsmith.operators.quantile import to_long


def ratio_features(df: DataFrame, spec: list[tuple[str, str, str, str]], eps: float = RATIO_EPS) -> DataFrame:
    """F1 / F2: append a/(b+eps) ('ratio') or (a-b)/(a+b+eps) ('normdiff'); a pair is
    used only when both columns exist. Division by an exact zero gives NULL."""
    new = []
    for name, a, b, kind in spec:
        if a not in df.columns or b not in df.columns:
            continue
        ca, cb = F.col(a), F.col(b)
        if kind == "ratio":
            new.append(F.try_divide(ca, cb + F.lit(eps)).alias(name))
        elif kind == "normdiff":
            new.append(F.try_divide(ca - cb, ca + cb + F.lit(eps)).alias(name))
        else:
            raise ValueError(f"unknown ratio kind {kind!r}")
    return df.select("*", *new)


def interaction_names(cols: list[str], top_n: int = INTERACTION_TOP_N) -> list[tuple[str, str, str]]:
    head = cols[:top_n]
    if len(head) < 2:
        return []
    return [(f"{a}_x_{b}", a, b) for a, b in combinations(head, 2)]


def interaction_features(df: DataFrame, top_n: int = INTERACTION_TOP_N, exclude: tuple = (),
                         cols: list[str] | None = None) -> DataFrame:
    """pairwise products of the first ``top_n`` numeric columns, named ``A_x_B``."""
    cols = cols if cols is not None else numeric_columns(df, exclude)
    return df.select("*", *[(F.col(a) * F.col(b)).alias(n) for n, a, b in interaction_names(cols, top_n)])


def anova_f(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """one-way ANOVA F per feature → (feature, feature_index, f_score).

    One pass: unpivot, then ``groupBy(feature, class)`` of count / mean / var_pop
    (partial aggregation map-side; k x features rows shuffled). Then
    SSB = sum n_g (mean_g - grand)^2, SSW = sum n_g var_g, F = (SSB/(k-1)) / (SSW/(n-k)).
    """
    long = to_long(df, cols, [label])
    g = long.groupBy("feature", label).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"),
                                          F.var_pop("value").alias("v"))
    w = Window.partitionBy("feature")
    g = g.withColumn("grand", F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w))
    per = g.groupBy("feature").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    idx = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, feature_index int")
    fs = F.try_divide(F.col("ssb") / (F.col("k") - 1), F.col("ssw") / (F.col("n") - F.col("k")))
    return per.join(F.broadcast(idx), "feature").select("feature", "feature_index", fs.alias("f_score"))


def select_top_k(scores: DataFrame, k: int = K_BEST) -> DataFrame:
    """top-k by F (ties at the cut prefer the later column, as SelectKBest),
    returned in original column order → (feature, feature_index, f_score)."""
    w = Window.orderBy(F.desc_nulls_last("f_score"), F.desc("feature_index"))
    top = scores.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    return top.orderBy("feature_index")


def top_features(scores: DataFrame, n: int = TOP_LOG) -> DataFrame:
    """(rank, feature, f_score) of the n best features (ties: earlier column first)."""
    w = Window.orderBy(F.desc_nulls_last("f_score"), F.asc("feature_index"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(
        "rank", "feature", "f_score")


@dataclass
class FeatureSelector:
    """Fitted feature engineering + selection."""

    ratio_spec: list = field(default_factory=list)
    top_n: int = INTERACTION_TOP_N
    k_best: int = K_BEST
    methods: tuple = ("ratios", "interactions")
    exclude: tuple = ()
    selected: list[str] | None = None
    scores: DataFrame | None = None

    def engineer(self, df: DataFrame) -> DataFrame:
        out = df
        if "ratios" in self.methods:
            out = ratio_features(out, self.ratio_spec)
        if "interactions" in self.methods:
            out = interaction_features(out, self.top_n, self.exclude)
        return out

    def fit(self, df: DataFrame, label: str) -> "FeatureSelector":
        eng = self.engineer(df)
        cols = numeric_columns(eng, tuple(self.exclude) + (label,))
        if len(cols) > self.k_best:
            self.scores = anova_f(eng, cols, label)
            # k feature names (bounded by k) come to the driver to build the projection.
            names = [r["feature"] for r in select_top_k(self.scores, self.k_best).collect()]
            self.selected = [c for c in cols if c in set(names)]
        else:
            self.selected = cols
        return self

    def transform(self, df: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
        eng = self.engineer(df)
        return eng.select(*keep, *[c for c in self.selected if c in eng.columns])
