"""Reproducible noise injection.

Every random draw is keyed by (row key, feature, noise id, seed), so the same
configuration gives the same noisy table at any partitioning and for every
model (the original shares one advancing generator, so each model saw other
noise). Column statistics come from one aggregate and a one-row broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.keyed import keyed_normal, keyed_uniform
from tabsmith.functions.presets import NOISE_CONFIGS, OUTLIER_MAGNITUDE, SEED
from tabsmith.operators.split import class_rank
from tabsmith.operators.stats import attach, moments

NOISE_TYPES = ("gaussian", "salt_pepper", "label", "outlier")


def noise_configs(spark) -> DataFrame:
    """The 14 configurations → (noise_id, type, param, ratio, label, category)."""
    rows = []
    for i, (t, p) in enumerate(NOISE_CONFIGS):
        name = {"gaussian": "gaussian sigma", "salt_pepper": "salt-pepper", "label": "label flip",
                "outlier": "outlier"}[t]
        rows.append((i + 1, t, float(p), p / 100.0, f"{name} {int(p)}%", "label" if t == "label" else "feature"))
    return spark.createDataFrame(rows, "noise_id int, type string, param double, ratio double, label string, "
                                       "category string")


def _tag(noise_id, c: str, what: str):
    return F.concat(F.lit(f"{what}|"), F.lit(str(noise_id)), F.lit(f"|{c}"))


def add_gaussian(df: DataFrame, cols: list[str], key: str, ratio: float, noise_id=0, seed: int = SEED,
                 stats: DataFrame | None = None) -> DataFrame:
    """X + N(0, ratio · std_pop(x)) per cell."""
    j, stat = attach(df, moments(df, cols) if stats is None else stats, [])
    sel = [(F.col(c) + F.lit(ratio) * stat("std", c) * keyed_normal(key, _tag(noise_id, c, "g"), seed)).alias(c)
           if c in cols else F.col(c) for c in df.columns]
    return j.select(*sel)


def add_salt_pepper(df: DataFrame, cols: list[str], key: str, ratio: float, noise_id=0,
                    seed: int = SEED, stats: DataFrame | None = None) -> DataFrame:
    """Each cell with probability ``ratio`` becomes its column's min or max (50/50)."""
    j, stat = attach(df, moments(df, cols) if stats is None else stats, [])
    sel = []
    for c in df.columns:
        if c not in cols:
            sel.append(F.col(c))
            continue
        hit = keyed_uniform(key, _tag(noise_id, c, "sp"), seed) < ratio
        low = keyed_uniform(key, _tag(noise_id, c, "spv"), seed) < 0.5
        sel.append(F.when(hit, F.when(low, stat("min", c)).otherwise(stat("max", c))).otherwise(F.col(c)).alias(c))
    return j.select(*sel)


def add_outliers(df: DataFrame, cols: list[str], key: str, ratio: float, magnitude: float = OUTLIER_MAGNITUDE,
                 noise_id=0, seed: int = SEED, stats: DataFrame | None = None) -> DataFrame:
    """Each cell with probability ``ratio`` becomes mean ± magnitude · std_pop."""
    j, stat = attach(df, moments(df, cols) if stats is None else stats, [])
    sel = []
    for c in df.columns:
        if c not in cols:
            sel.append(F.col(c))
            continue
        hit = keyed_uniform(key, _tag(noise_id, c, "o"), seed) < ratio
        sign = F.when(keyed_uniform(key, _tag(noise_id, c, "os"), seed) < 0.5, F.lit(1.0)).otherwise(F.lit(-1.0))
        sel.append(F.when(hit, stat("mean", c) + sign * F.lit(magnitude) * stat("std", c)).otherwise(F.col(c)).alias(c))
    return j.select(*sel)


def add_label_noise(df: DataFrame, label: str, key: str, ratio: float, n_classes: int, noise_id=0,
                    seed: int = SEED) -> DataFrame:
    """Exactly int(n · ratio) rows (smallest keyed hashes) get a uniformly drawn *other* class."""
    n = df.count()
    n_flip = int(n * ratio)
    tag = f"flip|{noise_id}"
    ranked = class_rank(df.withColumn("_all", F.lit(0)), "_all", key, tag, seed, out="_frank").drop("_all")
    shift = 1 + F.floor(keyed_uniform(key, F.lit(f"to|{noise_id}"), seed) * (n_classes - 1)).cast("int")
    new = ((F.col(label) + shift) % n_classes).cast(df.schema[label].dataType)
    return ranked.withColumn(label, F.when(F.col("_frank") < n_flip, new).otherwise(F.col(label))).drop("_frank")


def apply_noise(df: DataFrame, cols: list[str], label: str, key: str, noise_type: str, param: float,
                n_classes: int, noise_id=0, seed: int = SEED, stats: DataFrame | None = None) -> DataFrame:
    """Dispatch on the type; ``param`` is a percentage. Unknown types are an error.

    ``stats`` (``moments`` of the columns) can be given when many settings share one table."""
    r = param / 100.0
    if noise_type == "gaussian":
        return add_gaussian(df, cols, key, r, noise_id, seed, stats)
    if noise_type == "salt_pepper":
        return add_salt_pepper(df, cols, key, r, noise_id, seed, stats)
    if noise_type == "label":
        return add_label_noise(df, label, key, r, n_classes, noise_id, seed)
    if noise_type == "outlier":
        return add_outliers(df, cols, key, r, noise_id=noise_id, seed=seed, stats=stats)
    raise ValueError(f"unknown noise type {noise_type!r}; use one of {NOISE_TYPES}")
