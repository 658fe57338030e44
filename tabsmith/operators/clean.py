"""Cleaning: label repair (C1-C4, C10), dirty numbers (C5-C8), composite (C11)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tabsmith.session import hold
from pyspark.sql import types as T

from tabsmith.functions.parse import null_tokens, safe_double, strip_blanks
from tabsmith.functions.presets import SUFFIX, SUFFIX_PROBE, variant_map


def _map_expr(pairs: list[tuple[str, str]]) -> F.Column:
    return F.create_map(*chain.from_iterable((F.lit(a), F.lit(b)) for a, b in pairs))


def repair_labels(df: DataFrame, col: str, canonical: list[str], label_map: list[tuple[str, str]] | None = None,
                  out: str = "label", valid_col: str = "valid") -> DataFrame:
    """Strip, map dirty spellings, flag canonical membership (NULL is invalid).

    The map is a fixed literal ``create_map`` (a few dozen entries), evaluated
    inside whole-stage codegen: no join, no shuffle.
    """
    pairs = label_map if label_map is not None else variant_map(canonical)
    stripped = strip_blanks(F.col(col))
    mapped = F.coalesce(F.try_element_at(_map_expr(pairs), stripped), stripped)
    valid = F.coalesce(mapped.isin(*canonical), F.lit(False))
    return df.withColumn(out, mapped).withColumn(valid_col, valid)


def label_report(df: DataFrame, col: str, canonical: list[str],
                 label_map: list[tuple[str, str]] | None = None) -> DataFrame:
    """C4: long report (section, label, target, n) from one ``groupBy(raw label)``.

    Sections: 'summary' (original_unique, invalid_removed, cleaned_unique),
    'variant' (dirty spelling → target, count), 'invalid' (label, count),
    'final' (class distribution). Invalid labels are rows, never a collected list.
    """
    per_raw = df.groupBy(F.col(col).alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    pairs = label_map if label_map is not None else variant_map(canonical)
    s = strip_blanks(F.col("raw"))
    t = per_raw.select("raw", "n", s.alias("stripped"),
                       F.try_element_at(_map_expr(pairs), s).alias("mapped"))
    t = t.withColumn("clean", F.coalesce("mapped", "stripped"))
    t = hold(t.withColumn("valid", F.coalesce(F.col("clean").isin(*canonical), F.lit(False))))
    variants = (t.where(F.col("mapped").isNotNull()).groupBy(F.col("stripped").alias("label"))
                .agg(F.first("mapped").alias("target"), F.sum("n").alias("n"))
                .select(F.lit("variant").alias("section"), "label", "target", "n"))
    invalid = (t.where(~F.col("valid")).groupBy(F.col("clean").alias("label"))
               .agg(F.sum("n").alias("n"))
               .select(F.lit("invalid").alias("section"), "label", F.lit(None).cast("string").alias("target"), "n"))
    final = (t.where(F.col("valid")).groupBy(F.col("clean").alias("label")).agg(F.sum("n").alias("n"))
             .select(F.lit("final").alias("section"), "label", F.col("label").alias("target"), "n"))
    summ = t.agg(F.count(F.col("raw")).alias("original_unique"),
                 F.coalesce(F.sum(F.when(~F.col("valid"), F.col("n"))), F.lit(0)).alias("invalid_removed"),
                 F.count_distinct(F.when(F.col("valid"), F.col("clean"))).alias("cleaned_unique"))
    summ = summ.unpivot([], ["original_unique", "invalid_removed", "cleaned_unique"], "label", "n").select(
        F.lit("summary").alias("section"), "label", F.lit(None).cast("string").alias("target"), "n")
    out = summ.unionByName(variants).unionByName(invalid).unionByName(final)
    return out.select("section", "label", "target", F.col("n").cast("long").alias("n"))


def invalid_rows(df: DataFrame, valid_col: str = "valid") -> DataFrame:
    """The rows whose label is not canonical."""
    return df.where(~F.col(valid_col))


def parse_suffix(df: DataFrame, col: str, suffix: str = SUFFIX, out: str | None = None) -> DataFrame:
    """Remove the literal suffix (e.g. ' cm'), strip, then safe-cast (unparsable → NULL)."""
    txt = strip_blanks(F.replace(F.col(col).cast("string"), F.lit(suffix), F.lit("")))
    return df.withColumn(out or col, safe_double(txt))


def suffix_count(df: DataFrame, cols: list[str], probe: str = SUFFIX_PROBE) -> DataFrame:
    """C5 audit: (column, affected_rows) = values containing ``probe`` (one pass)."""
    agg = df.agg(*[F.count_if(F.col(c).contains(probe)).alias(c) for c in cols])
    return agg.unpivot([], cols, "column", "affected_rows").select(
        "column", F.col("affected_rows").cast("long").alias("affected_rows"))


def to_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """C6 + C7: null tokens then guarded numeric cast, all columns in one ``select``."""
    sel = []
    for f in df.schema.fields:
        if f.name not in cols:
            sel.append(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            sel.append(safe_double(null_tokens(F.col(f.name))).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            x = F.col(f.name).cast("double")
            sel.append(F.when(~F.isnan(x), x).alias(f.name))
        else:
            sel.append(F.lit(None).cast("double").alias(f.name))
    return df.select(*sel)


def numeric_columns(df: DataFrame, exclude: list[str] | tuple = ()) -> list[str]:
    """Names of numeric columns, schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def clean(df: DataFrame, label_col: str, feature_cols: list[str], canonical: list[str],
          suffix_cols: list[str] = (), impute: str = "median", winsorize: str | None = "global",
          by: list[str] | None = None, key: str | None = None, label_map=None,
          quantile_method: str = "exact") -> DataFrame:
    """C11: labels → suffixes → null tokens / cast → impute → winsorize → drop invalid.

    Invalid-label rows take part in imputation and clipping statistics and are
    removed last (the original order). ``by`` (e.g. ['split']) keeps statistics
    per split, all splits in one job.
    """
    from tabsmith.operators.impute import impute_knn, impute_median
    from tabsmith.operators.outliers import winsorize as _winsorize

    by = list(by or [])
    out = repair_labels(df, label_col, canonical, label_map)
    for c in suffix_cols:
        out = parse_suffix(out, c)
    out = to_numeric(out, feature_cols)
    if impute == "median":
        out = impute_median(out, feature_cols, by=by, method=quantile_method)
    elif impute == "knn":
        out = impute_knn(out, feature_cols, key=key, by=by)
    elif impute not in (None, "none"):
        raise ValueError(f"unknown imputation strategy {impute!r}")
    if winsorize == "global":
        out = _winsorize(out, feature_cols, by=by, method=quantile_method)
    elif winsorize == "class":
        out = _winsorize(out, feature_cols, by=by + ["label"], method=quantile_method)
    return out.where(F.col("valid"))
