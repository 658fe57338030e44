"""Queries for the chart tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tabsmith.functions.keyed import u_sql
from tabsmith.functions.presets import overfit_level_sql, variant_map
from tabsmith.operators import charts as V
from tabsmith.operators import clean as C
from tabsmith.operators import compare as A
from tabsmith.operators import metrics as M
from tabsmith.operators import profile as P
from tabsmith.operators.features import anova_f
from tabsmith.operators.impute import impute_median
from tabsmith.plans import oracle_fixtures as OF
from tabsmith.plans import sqlgen as G
from tabsmith.plans.q_prep import EVENT_CLASSES
from tabsmith.plans.registry import query
from tabsmith.sources import fixtures as FX

LS = FX.LINE_FEATURES
LSW = OF.with_(OF.LINE_STATS)
DE = OF.with_(OF.DIRTY_EVENTS)


@query("class_distribution", LSW + """
SELECT class, n, n / sum(n) OVER () AS share FROM (SELECT class, count(*)::BIGINT AS n FROM line_stats GROUP BY class)""",
       doubles=("share",))
def class_distribution(spark, sf):
    """V1."""
    return P.class_distribution(FX.line_stats(spark, sf), "class")


def _miss(c):
    return f"CASE WHEN {c} IS NULL OR {c} IN ('?', '') THEN 1 ELSE 0 END"


@query("missing_map", DE + f""", s AS (SELECT * FROM dirty_events ORDER BY {u_sql('row_id', "'sample'")}, row_id LIMIT 200)
SELECT row_id, 'row_id' AS "column", (CASE WHEN row_id IS NULL THEN 1 ELSE 0 END)::INTEGER AS missing FROM s
UNION ALL SELECT row_id, 'label_raw', ({_miss('label_raw')})::INTEGER FROM s
UNION ALL SELECT row_id, 'num_raw', ({_miss('num_raw')})::INTEGER FROM s
UNION ALL SELECT row_id, 'user_id', (CASE WHEN user_id IS NULL THEN 1 ELSE 0 END)::INTEGER FROM s""")
def missing_map(spark, sf):
    """V2: 0/1 missing matrix of a 200-row keyed sample (the chart's sample size)."""
    d = FX.dirty_events(spark, sf)
    return P.missing_map(d, "row_id", d.columns)


_PAIRS = [(a, b) for i, a in enumerate(LS) for b in LS[: i + 1]]


@query("correlation_matrix", LSW + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM line_stats" for a, b in _PAIRS), doubles=("r",))
def correlation_matrix(spark, sf):
    """V3: lower triangle incl. diagonal."""
    return V.correlation_matrix(FX.line_stats(spark, sf), LS)


@query("histograms", LSW + f""", lg AS ({G.unpivot('line_stats', LS, [])}),
mm AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM lg GROUP BY feature),
b AS (SELECT lg.feature, lo, hi, (CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 40)), 39) END)::INTEGER AS bin
      FROM lg JOIN mm ON lg.feature = mm.feature)
SELECT feature, bin, lo + bin * ((hi - lo) / 40) AS lo, lo + (bin + 1) * ((hi - lo) / 40) AS hi, count(*)::BIGINT AS n
FROM b GROUP BY feature, bin, lo, hi""", doubles=("lo", "hi"))
def histograms(spark, sf):
    """V4: 40 equal-width bins per feature."""
    return V.histograms(FX.line_stats(spark, sf), LS)


@query("box_stats", LSW + f""", lg AS ({G.unpivot('line_stats', LS, ['class'])}),
q AS (SELECT class, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM lg GROUP BY class, feature),
j AS (SELECT lg.*, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM lg JOIN q ON lg.class = q.class AND lg.feature = q.feature)
SELECT class, feature, q1, median, q3, min(CASE WHEN value >= lo AND value <= hi THEN value END) AS whisker_lo,
       max(CASE WHEN value >= lo AND value <= hi THEN value END) AS whisker_hi,
       count_if(NOT (value >= lo AND value <= hi))::BIGINT AS n_outliers
FROM j GROUP BY class, feature, q1, median, q3""", doubles=("q1", "median", "q3"))
def box_stats(spark, sf):
    """V5: quartiles, whiskers and outliers per class x feature."""
    return V.box_stats(FX.line_stats(spark, sf), LS, "class")


def _kde_sql(src: str, tag: str) -> str:
    return f"""st_{tag} AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd FROM {src}),
h_{tag} AS (SELECT bin, n, lo, hi, sd, count(*) AS c, lo + (bin + 0.5) * ((hi - lo) / 1024) AS centre FROM (
   SELECT (CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 1024)), 1023) END)::INTEGER AS bin, n, lo, hi, sd
   FROM {src}, st_{tag}) GROUP BY bin, n, lo, hi, sd),
g_{tag} AS (SELECT range::INTEGER AS gi FROM range(0, 200)),
d_{tag} AS (SELECT gi, lo + gi * (hi - lo) / 199 AS x, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h,
              sum(c * exp(-0.5 * ((lo + gi * (hi - lo) / 199 - centre) / (sd * pow(CAST(n AS DOUBLE), -0.2)))
                               * ((lo + gi * (hi - lo) / 199 - centre) / (sd * pow(CAST(n AS DOUBLE), -0.2))))) AS s
            FROM h_{tag} CROSS JOIN g_{tag} GROUP BY gi, x, n, h)"""


@query("density_grid", OF.with_(OF.ORDER_FEATURES).rstrip() + f""",
med AS (SELECT quantile_cont(sum_price, 0.5) AS m FROM order_features),
before_ AS (SELECT sum_price AS x FROM order_features WHERE sum_price IS NOT NULL),
after_ AS (SELECT coalesce(sum_price, m) AS x FROM order_features, med),
{_kde_sql('before_', 'b')},
{_kde_sql('after_', 'a')}
SELECT 'before' AS series, gi, x, s / (n * h * {math.sqrt(2 * math.pi)!r}) AS density FROM d_b
UNION ALL SELECT 'after', gi, x, s / (n * h * {math.sqrt(2 * math.pi)!r}) FROM d_a""", doubles=("x", "density"))
def density_grid(spark, sf):
    """V8: KDE of sum_price before / after median imputation."""
    of = FX.order_features(spark, sf)
    before = V.density_grid(of, "sum_price", tag="before")
    after = V.density_grid(impute_median(of, ["sum_price"]), "sum_price", tag="after")
    return before.unionByName(after)


@query("label_summary", DE + f""", per_raw AS (SELECT label_raw AS raw, count(*) AS n FROM dirty_events GROUP BY 1),
t AS (SELECT {G.strip('raw')} AS label, n, CASE {G.strip('raw')} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in
    variant_map(EVENT_CLASSES))} END AS target FROM per_raw),
v AS (SELECT label, first(target) AS target, sum(n)::BIGINT AS n FROM t WHERE target IS NOT NULL GROUP BY label)
SELECT label, target, n, row_number() OVER (ORDER BY n DESC, label) AS position FROM v""")
def label_summary(spark, sf):
    """V9: dirty spellings found, by count."""
    from pyspark.sql import Window
    rep = C.label_report(FX.dirty_events(spark, sf), "label_raw", EVENT_CLASSES).where(F.col("section") == "variant")
    return rep.select("label", "target", "n",
                      F.row_number().over(Window.orderBy(F.desc("n"), F.asc("label"))).alias("position"))


def _anova_top_sql(k: int) -> str:
    from tabsmith.plans.q_prep import _anova_sql
    return _anova_sql() + f"""
SELECT feature, f_score, rank FROM (
  SELECT feature, f_score, row_number() OVER (ORDER BY f_score DESC, feature) AS rank FROM scores) WHERE rank <= {k}"""


@query("importance_top", _anova_top_sql(20), doubles=("f_score",))
def importance_top(spark, sf):
    """Top-20 features by ANOVA F."""
    from tabsmith.plans.pipeline import engineered_columns, engineered_orders
    scores = anova_f(engineered_orders(spark, sf), engineered_columns(), "class")
    return V.top_k(scores, "f_score", 20)


# ---- projections of the comparison / metric tables
from tabsmith.plans.q_eval import _COMP, metric_ctes  # noqa: E402


def _comp(spark, sf):
    return A.comparison_table(FX.predictions(spark, sf))


@query("score_bars", _COMP + """
SELECT model, 'accuracy' AS metric, accuracy AS value FROM comp
UNION ALL SELECT model, 'balanced_accuracy', balanced_accuracy FROM comp
UNION ALL SELECT model, 'f1_weighted', f1_weighted FROM comp""", doubles=("value",))
def score_bars(spark, sf):
    """V11."""
    return V.score_bars(_comp(spark, sf))


@query("confusion_grid", metric_ctes() + """
SELECT model, actual, predicted, n, n / row_n AS share, n / row_n > 0.05 AS labelled FROM (
  SELECT *, sum(n) OVER (PARTITION BY model, actual) AS row_n FROM cm) WHERE row_n > 0""", doubles=("share",))
def confusion_grid(spark, sf):
    """V13."""
    return V.confusion_grid(M.confusion_normalised(FX.predictions(spark, sf).where(F.col("split") == "test"), ["model"]))


@query("f1_heatmap", metric_ctes() + "\nSELECT model, " + ", ".join(
    f"coalesce(max(CASE WHEN class = {c} THEN f1 END), 0.0) AS f1_{c}" for c in range(5)) + " FROM pc GROUP BY model",
       doubles=tuple(f"f1_{c}" for c in range(5)))
def f1_heatmap(spark, sf):
    """V14."""
    pc = M.per_class(FX.predictions(spark, sf).where(F.col("split") == "test"), ["model"])
    return V.f1_heatmap(pc, list(range(5)))


@query("overfitting_bars", _COMP + """
SELECT model, train_accuracy - accuracy AS gap, """ + overfit_level_sql("train_accuracy - accuracy")
       + " AS level FROM comp", doubles=("gap",))
def overfitting_bars(spark, sf):
    """V16."""
    c = _comp(spark, sf).select("model", "train_accuracy", F.col("accuracy").alias("test_accuracy"))
    return A.overfitting(c).select("model", "gap", "level")


@query("radar", _COMP + """
SELECT model, accuracy, balanced_accuracy, f1_weighted, cohen_kappa, least(1.0, 0.01 / greatest(0.01, 1e-6)) AS speed,
       greatest(0.0, 1 - 10 * (train_accuracy - accuracy)) AS anti_overfit FROM comp""",
       doubles=("accuracy", "balanced_accuracy", "f1_weighted", "cohen_kappa", "speed", "anti_overfit"))
def radar(spark, sf):
    """V22 (no timings in the fixture: speed uses the documented default t = .01)."""
    comp = _comp(spark, sf)
    over = A.overfitting(comp.select("model", "train_accuracy", F.col("accuracy").alias("test_accuracy")))
    return V.radar(comp, over)


# ---- ROC / PR on the predictions fixture (5 classes, 3 models, test split)

_ROC = metric_ctes() + """,
cl AS (SELECT range::INTEGER AS class FROM range(0, 5)),
sc AS (SELECT p.model, cl.class, p.proba[cl.class + 1] AS score,
              sum(CASE WHEN p.actual = cl.class THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN p.actual <> cl.class THEN 1 ELSE 0 END) AS neg
       FROM p CROSS JOIN cl GROUP BY p.model, cl.class, score),
cum AS (SELECT model, class, score,
               sum(pos) OVER (PARTITION BY model, class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (PARTITION BY model, class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
               sum(pos) OVER (PARTITION BY model, class) AS P, sum(neg) OVER (PARTITION BY model, class) AS N FROM sc),
pts AS (SELECT model, class, score AS threshold, CASE WHEN N > 0 THEN fp / N END AS fpr,
               CASE WHEN P > 0 THEN tp / P END AS tpr, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision FROM cum)"""


def _points(spark, sf):
    pred = FX.predictions(spark, sf).where(F.col("split") == "test")
    return V.roc_points(pred, ["model"], 5)


@query("roc_curve", _ROC + "\nSELECT model, class, threshold, fpr, tpr FROM pts")
def roc_curve(spark, sf):
    """One-vs-rest ROC points."""
    return _points(spark, sf).select("model", "class", "threshold", "fpr", "tpr")


@query("roc_auc", _ROC + """
SELECT model, class, sum((fpr - f0) * (tpr + t0) / 2) AS auc FROM (
  SELECT *, coalesce(lag(fpr) OVER (PARTITION BY model, class ORDER BY threshold DESC), 0.0) AS f0,
            coalesce(lag(tpr) OVER (PARTITION BY model, class ORDER BY threshold DESC), 0.0) AS t0 FROM pts)
GROUP BY model, class""", doubles=("auc",))
def roc_auc(spark, sf):
    """AUC per model x class."""
    return V.roc_auc(_points(spark, sf), ["model"])


@query("pr_curve", _ROC + "\nSELECT model, class, threshold, tpr AS recall, precision FROM pts")
def pr_curve(spark, sf):
    """Precision-recall points."""
    return _points(spark, sf).select("model", "class", "threshold", F.col("tpr").alias("recall"), "precision")


@query("average_precision", _ROC + """
SELECT model, class, sum((tpr - r0) * precision) AS average_precision FROM (
  SELECT *, coalesce(lag(tpr) OVER (PARTITION BY model, class ORDER BY threshold DESC), 0.0) AS r0 FROM pts)
GROUP BY model, class""", doubles=("average_precision",))
def average_precision(spark, sf):
    """AP per model x class."""
    return V.average_precision(_points(spark, sf), ["model"])


@query("curve_tail", _ROC + """
SELECT model, class, threshold, fpr, tpr FROM (
  SELECT *, count(*) OVER (PARTITION BY model, class) AS cnt,
         row_number() OVER (PARTITION BY model, class ORDER BY threshold) AS rd FROM pts)
WHERE cnt <= 100 OR rd <= 50""")
def curve_tail(spark, sf):
    """Last 50 points (lowest thresholds = curve end) of curves with more than 100."""
    pts = _points(spark, sf).select("model", "class", "threshold", "fpr", "tpr")
    # the curve runs from high to low thresholds: its tail is the lowest thresholds
    return V.curve_tail(pts.withColumn("_o", -F.col("threshold")), ["model", "class"], "_o").drop("_o")
