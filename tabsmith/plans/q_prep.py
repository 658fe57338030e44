"""Queries for profiling, cleaning, imputation, outliers and features (S, C, I, W, F)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabsmith.operators import clean as C
from tabsmith.operators import features as FE
from tabsmith.operators import impute as I
from tabsmith.operators import outliers as W
from tabsmith.operators import profile as P
from tabsmith.plans import oracle_fixtures as OF
from tabsmith.plans import sqlgen as G
from tabsmith.plans.pipeline import ORDER_RATIOS, engineered_columns, engineered_orders
from tabsmith.plans.registry import query
from tabsmith.sources import fixtures as FX
from tabsmith.operators import models as ML
from tabsmith.operators import scale as SC
from tabsmith.session import ensure_checkpoint_dir, hold
from tabsmith.sources import store as ST
from tabsmith.sources.io import load_splits, persist_table, read_table, tag_splits, write_csv
from tabsmith.functions.keyed import keyed_uniform, u_sql
from tabsmith.functions.presets import variant_map

# Canonical classes of the dirty-events fixture (upper-cased event types).
EVENT_CLASSES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
OFS = FX.ORDER_FEATURES
LS = FX.LINE_FEATURES
DE = OF.with_(OF.DIRTY_EVENTS)
OFW = OF.with_(OF.ORDER_FEATURES)
LSW = OF.with_(OF.LINE_STATS)

# ---------------------------------------------------------------- S: sources, profile


def _split_of(key):
    u = keyed_uniform(key, "split3")
    return F.when(u < 0.72, "train").when(u < 0.9, "test").otherwise("val")


@query("split_union", f"""
SELECT split, count(*)::BIGINT AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price FROM (
  SELECT *, CASE WHEN {u_sql('o_orderkey', "'split3'")} < 0.72 THEN 'train'
                 WHEN {u_sql('o_orderkey', "'split3'")} < 0.9 THEN 'test' ELSE 'val' END AS split
  FROM orders) GROUP BY split""", doubles=("total_price",))
def split_union(spark, sf):
    """Three named splits read separately, tagged and unioned by name."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    parts = {s: o.where(_split_of("o_orderkey") == s) for s in ("train", "test", "val")}
    u = tag_splits(parts)
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"))


def _miss(c, s=False):
    return f"sum(CASE WHEN {c} IS NULL {'OR ' + c + " IN ('?', '')" if s else ''} THEN 1 ELSE 0 END)"


@query("profile_summary", DE + f"""
SELECT count(*)::BIGINT AS n_samples, 3::BIGINT AS n_features, count(DISTINCT label_raw)::BIGINT AS n_classes,
  ({_miss('row_id')} + {_miss('label_raw', True)} + {_miss('num_raw', True)} + {_miss('user_id')})::BIGINT AS n_missing
FROM dirty_events""")
def profile_summary(spark, sf):
    """S3."""
    return P.summary(FX.dirty_events(spark, sf), "label_raw")


@query("missing_counts", DE + f"""
SELECT 'row_id' AS "column", {_miss('row_id')}::BIGINT AS n_missing FROM dirty_events UNION ALL
SELECT 'label_raw', {_miss('label_raw', True)}::BIGINT FROM dirty_events UNION ALL
SELECT 'num_raw', {_miss('num_raw', True)}::BIGINT FROM dirty_events UNION ALL
SELECT 'user_id', {_miss('user_id')}::BIGINT FROM dirty_events""")
def missing_counts(spark, sf):
    """C9 / S3."""
    return P.missing_counts(FX.dirty_events(spark, sf))


@query("missing_after_impute", OFW + """, med AS (SELECT """ + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}" for c in OFS) + """ FROM order_features),
imp AS (SELECT """ + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in OFS) + """ FROM order_features, med)
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if({c} IS NULL)::BIGINT AS n_missing FROM imp" for c in OFS))
def missing_after_impute(spark, sf):
    """Missing counts after median imputation (all zero)."""
    imp = I.impute_median(FX.order_features(spark, sf), OFS)
    return P.missing_counts(imp, OFS)


# ---------------------------------------------------------------- C: labels and numbers

_LBL = G.label_sql("label_raw", EVENT_CLASSES)


@query("label_repair", DE + f"""
SELECT row_id, label_raw, lbl AS label, {G.valid_sql('lbl', EVENT_CLASSES)} AS valid
FROM (SELECT *, {_LBL} AS lbl FROM dirty_events)""")
def label_repair(spark, sf):
    """C1-C3."""
    d = C.repair_labels(FX.dirty_events(spark, sf), "label_raw", EVENT_CLASSES)
    return d.select("row_id", "label_raw", "label", "valid")


@query("invalid_rows", DE + f"""
SELECT row_id, label_raw, lbl AS label FROM (SELECT *, {_LBL} AS lbl FROM dirty_events)
WHERE NOT {G.valid_sql('lbl', EVENT_CLASSES)}""")
def invalid_rows(spark, sf):
    """C10 (the removed rows)."""
    d = C.repair_labels(FX.dirty_events(spark, sf), "label_raw", EVENT_CLASSES)
    return C.invalid_rows(d).select("row_id", "label_raw", "label")


_MAPPED = "CASE " + G.strip("raw") + " " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in variant_map(EVENT_CLASSES)) + " END"


@query("label_report", DE + f""", per_raw AS (SELECT label_raw AS raw, count(*) AS n FROM dirty_events GROUP BY 1),
t AS (SELECT raw, n, {G.strip('raw')} AS stripped, {_MAPPED} AS mapped FROM per_raw),
t2 AS (SELECT *, coalesce(mapped, stripped) AS clean, {G.valid_sql('coalesce(mapped, stripped)', EVENT_CLASSES)} AS valid FROM t)
SELECT 'summary' AS section, 'original_unique' AS label, NULL::VARCHAR AS target, count(raw)::BIGINT AS n FROM t2
UNION ALL SELECT 'summary', 'invalid_removed', NULL, coalesce(sum(CASE WHEN NOT valid THEN n END), 0)::BIGINT FROM t2
UNION ALL SELECT 'summary', 'cleaned_unique', NULL, count(DISTINCT CASE WHEN valid THEN clean END)::BIGINT FROM t2
UNION ALL SELECT 'variant', stripped, first(mapped), sum(n)::BIGINT FROM t2 WHERE mapped IS NOT NULL GROUP BY stripped
UNION ALL SELECT 'invalid', clean, NULL, sum(n)::BIGINT FROM t2 WHERE NOT valid GROUP BY clean
UNION ALL SELECT 'final', clean, clean, sum(n)::BIGINT FROM t2 WHERE valid GROUP BY clean""")
def label_report(spark, sf):
    """C4 (and V9's data)."""
    return C.label_report(FX.dirty_events(spark, sf), "label_raw", EVENT_CLASSES)


@query("parse_suffix", DE + f"""
SELECT row_id, num_raw, {G.suffix_sql('num_raw')} AS num FROM dirty_events""")
def parse_suffix(spark, sf):
    """C5."""
    return C.parse_suffix(FX.dirty_events(spark, sf), "num_raw", out="num").select("row_id", "num_raw", "num")


@query("suffix_stats", DE + """
SELECT 'num_raw' AS "column", count_if(num_raw LIKE '%cm%')::BIGINT AS affected_rows FROM dirty_events""")
def suffix_stats(spark, sf):
    """C5 audit."""
    return C.suffix_count(FX.dirty_events(spark, sf), ["num_raw"])


@query("null_tokens", DE + f"""
SELECT row_id, {G.null_token_sql('num_raw')} AS num_token, {G.safe_double_sql(G.null_token_sql('num_raw'))} AS num_value
FROM dirty_events""")
def null_tokens(spark, sf):
    """C6 + C7: null tokens then guarded cast (no suffix handling)."""
    from tabsmith.functions.parse import null_tokens as nt
    d = FX.dirty_events(spark, sf).select("row_id", nt(F.col("num_raw")).alias("num_token"), "num_raw")
    return C.to_numeric(d.withColumnRenamed("num_raw", "num_value").withColumn("num_value", F.col("num_token")),
                        ["num_value"]).select("row_id", "num_token", "num_value")


@query("numeric_columns", OFW + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count({c})::BIGINT AS n, sum({c})::DOUBLE AS total FROM order_features"
    for i, c in enumerate(["row_id"] + OFS)), doubles=("total",))
def numeric_columns(spark, sf):
    """The numeric projection of the order fixture, each column's values counted and summed over all rows."""
    df = FX.order_features(spark, sf)
    names = C.numeric_columns(df)
    agg = df.select(*names).agg(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.count(c).alias("n"),
                                           F.sum(F.col(c).cast("double")).alias("total")).alias(c) for i, c in enumerate(names)])
    return agg.select(F.explode(F.array(*names)).alias("r")).select("r.*")


_CLEAN_SQL = DE + f""", lab AS (
  SELECT row_id, {_LBL} AS label, {G.suffix_sql('num_raw')} AS num_raw, CAST(user_id AS DOUBLE) AS user_id FROM dirty_events),
lab2 AS (SELECT *, {G.valid_sql('label', EVENT_CLASSES)} AS valid FROM lab),
med AS (SELECT quantile_cont(num_raw, 0.5) AS m_num, quantile_cont(user_id, 0.5) AS m_user FROM lab2),
imp AS (SELECT row_id, label, valid, coalesce(num_raw, m_num) AS num_raw, coalesce(user_id, m_user) AS user_id
        FROM lab2, med),
q AS (SELECT quantile_cont(num_raw, 0.25) AS a1, quantile_cont(num_raw, 0.75) AS a3,
             quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM imp)
SELECT row_id, label, {G.clip_sql('num_raw', 'a1 - 1.5 * (a3 - a1)', 'a3 + 1.5 * (a3 - a1)')} AS num_raw,
       {G.clip_sql('user_id', 'b1 - 1.5 * (b3 - b1)', 'b3 + 1.5 * (b3 - b1)')} AS user_id
FROM imp, q WHERE valid"""


@query("clean_pipeline", _CLEAN_SQL, doubles=("num_raw", "user_id"))
def clean_pipeline(spark, sf):
    """C11: labels → suffix → tokens/cast → median impute → global winsorize → drop invalid."""
    d = C.clean(FX.dirty_events(spark, sf), "label_raw", ["num_raw", "user_id"], EVENT_CLASSES,
                suffix_cols=["num_raw"], impute="median", winsorize="global")
    return d.select("row_id", "label", "num_raw", "user_id")


# ---------------------------------------------------------------- I: imputation

_MED = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in OFS)


@query("impute_median", OFW + f""", med AS (SELECT {_MED} FROM order_features)
SELECT row_id, class, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in OFS)} FROM order_features, med""",
       doubles=tuple(OFS))
def impute_median(spark, sf):
    """I2."""
    return I.impute_median(FX.order_features(spark, sf), OFS)


def _knn_impute_sql() -> str:
    n = len(OFS)
    terms = " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0.0)" for c in OFS)
    present = " + ".join(f"(CASE WHEN q.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in OFS)
    anynull = " OR ".join(f"{c} IS NULL" for c in OFS)
    branches = []
    for i, c in enumerate(OFS):
        branches.append(f"""SELECT qid, {i} AS ci, avg(v) AS fill FROM (
    SELECT qid, d_{c} AS v, row_number() OVER (PARTITION BY qid ORDER BY dist, did) AS rn
    FROM pairs WHERE q_{c} IS NULL AND d_{c} IS NOT NULL) WHERE rn <= 5 GROUP BY qid""")
    dcols = ", ".join(f"d.{c} AS d_{c}, q.{c} AS q_{c}" for c in OFS)
    means = ", ".join(f"avg({c}) AS mean_{c}" for c in OFS)
    fills = ", ".join(f"max(CASE WHEN ci = {i} THEN fill END) AS f_{c}" for i, c in enumerate(OFS))
    sel = ", ".join(f"coalesce(o.{c}, f.f_{c}, mean_{c}) AS {c}" for c in OFS)
    return OFW + f""", qs AS (SELECT * FROM order_features WHERE {anynull}),
pairs0 AS (SELECT q.row_id AS qid, d.row_id AS did, {terms} AS ss, {present} AS present, {dcols}
           FROM qs q CROSS JOIN order_features d),
pairs AS (SELECT *, sqrt(ss * ({float(n)} / present)) AS dist FROM pairs0 WHERE present > 0),
fl AS ({' UNION ALL '.join(branches)}),
f AS (SELECT qid, {fills} FROM fl GROUP BY qid),
m AS (SELECT {means} FROM order_features)
SELECT o.row_id, o.class, {sel} FROM order_features o LEFT JOIN f ON o.row_id = f.qid CROSS JOIN m"""


@query("impute_knn", _knn_impute_sql(), doubles=tuple(OFS))
def impute_knn(spark, sf):
    """k=5 NaN-aware Euclidean KNN imputation."""
    return I.impute_knn(FX.order_features(spark, sf), OFS, key="row_id")


# ---------------------------------------------------------------- W: outliers

def _bounds_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    parts = []
    for c in LS:
        parts.append(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}")
    grp = f" GROUP BY {by}" if by else ""
    return f"SELECT {g}{', '.join(parts)} FROM line_stats{grp}"


def _clip_all(prefix="b.") -> str:
    out = []
    for c in LS:
        lo = f"({prefix}q1_{c} - 1.5 * ({prefix}q3_{c} - {prefix}q1_{c}))"
        hi = f"({prefix}q3_{c} + 1.5 * ({prefix}q3_{c} - {prefix}q1_{c}))"
        out.append(f"{G.clip_sql('l.' + c, lo, hi)} AS {c}")
    return ", ".join(out)


@query("winsorize_global", LSW + f""", b AS ({_bounds_sql(None)})
SELECT l.class, {_clip_all()} FROM line_stats l CROSS JOIN b""", doubles=tuple(LS))
def winsorize_global(spark, sf):
    """W1."""
    return W.winsorize(FX.line_stats(spark, sf), LS)


@query("winsorize_by_class", LSW + f""", b AS ({_bounds_sql('class')})
SELECT l.class, {_clip_all()} FROM line_stats l JOIN b ON l.class = b.class""", doubles=tuple(LS))
def winsorize_by_class(spark, sf):
    """W2."""
    return W.winsorize(FX.line_stats(spark, sf), LS, by=["class"])


def _outlier_sql() -> str:
    parts = []
    for c in LS:
        lo = f"(b.q1_{c} - 1.5 * (b.q3_{c} - b.q1_{c}))"
        hi = f"(b.q3_{c} + 1.5 * (b.q3_{c} - b.q1_{c}))"
        parts.append(f"SELECT l.class, '{c}' AS \"column\", count_if(l.{c} < {lo} OR l.{c} > {hi})::BIGINT AS n_outliers "
                     f"FROM line_stats l JOIN b ON l.class = b.class GROUP BY l.class")
    return LSW + f", b AS ({_bounds_sql('class')})\nSELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n_outliers > 0"


@query("outlier_counts", _outlier_sql())
def outlier_counts(spark, sf):
    """W2 audit: per class x column outliers."""
    return W.outlier_counts(FX.line_stats(spark, sf), LS, by=["class"])


# ---------------------------------------------------------------- F: features

def _ratio_sql(a, b, kind):
    if kind == "ratio":
        return f"CASE WHEN ({b} + 1e-8) = 0 THEN NULL ELSE {a} / ({b} + 1e-8) END"
    return f"CASE WHEN ({a} + {b} + 1e-8) = 0 THEN NULL ELSE ({a} - {b}) / ({a} + {b} + 1e-8) END"


_RATIO_COLS = [r[0] for r in ORDER_RATIOS]


@query("ratio_features", OFW + f"""
SELECT row_id, {', '.join(f'{_ratio_sql(a, b, k)} AS {n}' for n, a, b, k in ORDER_RATIOS)} FROM order_features""")
def ratio_features(spark, sf):
    """F1 / F2."""
    return FE.ratio_features(FX.order_features(spark, sf), ORDER_RATIOS).select("row_id", *_RATIO_COLS)


_INTER = FE.interaction_names(OFS)


@query("interaction_features", OFW + f"""
SELECT row_id, {', '.join(f'{a} * {b} AS {n}' for n, a, b in _INTER)} FROM order_features""")
def interaction_features(spark, sf):
    """F3."""
    return FE.interaction_features(FX.order_features(spark, sf), cols=OFS).select(
        "row_id", *[n for n, _, _ in _INTER])


def _engineered_sql() -> str:
    """order_features → median impute → per-class winsorize → ratios → interactions (DuckDB)."""
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in OFS)
    imp = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in OFS)
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in OFS)
    clip = ", ".join(G.clip_sql(f"i.{c}", f"(b.q1_{c} - 1.5 * (b.q3_{c} - b.q1_{c}))",
                                f"(b.q3_{c} + 1.5 * (b.q3_{c} - b.q1_{c}))") + f" AS {c}" for c in OFS)
    ratios = ", ".join(f"{_ratio_sql(a, b, k)} AS {n}" for n, a, b, k in ORDER_RATIOS)
    cols = OFS + _RATIO_COLS
    inter = ", ".join(f"{a} * {b} AS {n}" for n, a, b in FE.interaction_names(cols))
    return OFW + f""", med AS (SELECT {med} FROM order_features),
imp AS (SELECT row_id, class, {imp} FROM order_features, med),
b AS (SELECT class, {qs} FROM imp GROUP BY class),
win AS (SELECT i.row_id, i.class, {clip} FROM imp i JOIN b ON i.class = b.class),
rat AS (SELECT *, {ratios} FROM win),
eng AS (SELECT *, {inter} FROM rat)"""


_ENG_COLS = engineered_columns()


def _anova_sql() -> str:
    long = G.unpivot("eng", _ENG_COLS, ["class"])
    idx = ", ".join(f"('{c}', {i})" for i, c in enumerate(_ENG_COLS))
    return _engineered_sql() + f""",
lg AS ({long}),
g AS (SELECT feature, class, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM lg GROUP BY feature, class),
g2 AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g),
per AS (SELECT feature, sum(n * (m - grand) * (m - grand)) AS ssb, sum(n * v) AS ssw, sum(n) AS n, count(*) AS k
        FROM g2 GROUP BY feature),
idx AS (SELECT * FROM (VALUES {idx}) t(feature, feature_index)),
scores AS (SELECT per.feature, idx.feature_index::INTEGER AS feature_index,
                  CASE WHEN ssw = 0 THEN NULL ELSE (ssb / (k - 1)) / (ssw / (n - k)) END AS f_score
           FROM per JOIN idx ON per.feature = idx.feature)"""


@query("anova_f_scores", _anova_sql() + "\nSELECT feature, feature_index, f_score FROM scores", doubles=("f_score",))
def anova_f_scores(spark, sf):
    """F4 on the engineered order features."""
    return FE.anova_f(engineered_orders(spark, sf), _ENG_COLS, "class")


@query("select_top_k", _anova_sql() + """
SELECT feature, feature_index, f_score FROM (
  SELECT *, row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature_index DESC) AS r FROM scores) WHERE r <= 30""",
       doubles=("f_score",))
def select_top_k(spark, sf):
    """top-30 by F, original order."""
    return FE.select_top_k(FE.anova_f(engineered_orders(spark, sf), _ENG_COLS, "class"), 30)


@query("top10_features", _anova_sql() + """
SELECT rank, feature, f_score FROM (
  SELECT feature, f_score, row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature_index) AS rank FROM scores)
WHERE rank <= 10""", doubles=("f_score",))
def top10_features(spark, sf):
    """F6."""
    return FE.top_features(FE.anova_f(engineered_orders(spark, sf), _ENG_COLS, "class"), 10)


@query("feature_ranking", _anova_sql() + """
SELECT rank, feature, f_score FROM (
  SELECT feature, f_score, row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature_index) AS rank FROM scores)""",
       doubles=("f_score",))
def feature_ranking(spark, sf):
    """Flagship: full ANOVA ranking of the engineered order features."""
    from tabsmith.plans.pipeline import flagship
    return flagship(spark, sf)


_VEC = FX.VECTOR_FEATURES


def _vec_anova_sql() -> str:
    long = G.unpivot("vectors", _VEC, ["label"])
    idx = ", ".join(f"('{c}', {i})" for i, c in enumerate(_VEC))
    return OF.with_(OF.VECTORS) + f""",
lg AS ({long}),
g AS (SELECT feature, label, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM lg GROUP BY feature, label),
g2 AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g),
per AS (SELECT feature, sum(n * (m - grand) * (m - grand)) AS ssb, sum(n * v) AS ssw, sum(n) AS n, count(*) AS k
        FROM g2 GROUP BY feature),
idx AS (SELECT * FROM (VALUES {idx}) t(feature, feature_index))
SELECT per.feature, idx.feature_index::INTEGER AS feature_index,
       CASE WHEN ssw = 0 THEN NULL ELSE (ssb / (k - 1)) / (ssw / (n - k)) END AS f_score
FROM per JOIN idx ON per.feature = idx.feature"""


@query("anova_vectors", _vec_anova_sql(), doubles=("f_score",))
def anova_vectors(spark, sf):
    """F4 on the 64-dimensional vectors."""
    return FE.anova_f(FX.vectors(spark, sf), _VEC, "label")


@query("apply_selection", _anova_sql() + """,
top AS (SELECT feature FROM (SELECT *, row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature_index DESC) AS r
        FROM scores) WHERE r <= 30)
SELECT (row_number() OVER (ORDER BY feature_index) - 1)::INTEGER AS position, feature, count(value)::BIGINT AS n, sum(value) AS total
FROM lg JOIN top USING (feature) JOIN idx USING (feature) GROUP BY feature, feature_index""", doubles=("total",))
def apply_selection(spark, sf):
    """Fit the selector on the order fixture and replay it: each selected column with its values' count and sum."""
    of = FX.order_features(spark, sf)
    prepared = hold(W.winsorize(I.impute_median(of, OFS), OFS, by=["class"]))
    sel = FE.FeatureSelector(ratio_spec=ORDER_RATIOS, k_best=30, exclude=("row_id",)).fit(prepared, "class")
    out = sel.transform(prepared)
    agg = out.agg(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.count(F.col(c)).alias("n"),
                             F.sum(F.col(c)).alias("total")).alias(f"c{i}") for i, c in enumerate(out.columns)])
    return agg.select(F.explode(F.array(*[f"c{i}" for i in range(len(out.columns))])).alias("r")).select("r.*")


# ---------------------------------------------------------------- S1, S2, S4-S6 over files

@query("csv_scan", DE + """
SELECT CASE row_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'val' END AS split, row_id::VARCHAR AS "row id", label_raw AS "label, raw",
       nullif(num_raw, '') AS num_raw, user_id::VARCHAR AS user_id FROM dirty_events""")
def csv_scan(spark, sf):
    """Three CSV splits that Spark writes from the dirty events (quoted and blank names, blanks in fields)
    read back as one all-string table; an empty field is missing, as in the original."""
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    ev = FX.dirty_events(spark, sf).select(F.col("row_id").alias(" row id "), F.col("label_raw").alias("label, raw"), "num_raw", "user_id")
    for i, split in enumerate(("train", "test", "val")):
        write_csv(ev.where(F.col(" row id ") % 3 == i), f"{folder}/{split}")
    out = load_splits(spark, {s: f"{folder}/{s}" for s in ("train", "test", "val")})
    return out.withColumn("num_raw", F.nullif("num_raw", F.lit("")))


@query("store_round_trip", OFW + """
SELECT what, count(*) AS n, true AS same FROM order_features CROSS JOIN (VALUES ('scaler'), ('selector'), ('model')) t(what) GROUP BY what""")
def store_round_trip(spark, sf):
    """Scaler, selector and classifier saved, loaded and applied to all rows give the rows of the unsaved ones."""
    folder = f"{ensure_checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"
    rows = persist_table(I.impute_median(FX.order_features(spark, sf), OFS), f"{folder}/rows", None)
    scaler = SC.Scaler("standard", OFS, []).fit(rows)
    ST.save_scaler(scaler, spark, f"{folder}/scaler")
    scaled = hold(scaler.transform(rows))
    same = {"scaler": ST.same_rows(scaled, ST.load_scaler(spark, f"{folder}/scaler").transform(rows))}
    sel = FE.FeatureSelector(ratio_spec=ORDER_RATIOS, k_best=10, exclude=("row_id",)).fit(rows, "class")
    ST.save_selector(sel, spark, f"{folder}/selector")
    same["selector"] = ST.same_rows(sel.transform(rows, ["row_id"]), ST.load_selector(spark, f"{folder}/selector").transform(rows, ["row_id"]))
    coded = hold(scaled.withColumn("y", F.substring("class", 1, 1).cast("int") - 1))
    fitted = ML.fit_model("logistic", coded, OFS, "y", "row_id", params={"max_iter": 30})
    ST.save_model(fitted, spark, f"{folder}/model")
    same["model"] = ST.same_rows(fitted.predict(coded, "all"), ST.load_model(spark, f"{folder}/model").predict(coded, "all"))
    table = spark.createDataFrame(list(same.items()), "what string, same boolean")
    return rows.agg(F.count("*").alias("n")).crossJoin(F.broadcast(table)).select("what", "n", "same")  # one row and three
