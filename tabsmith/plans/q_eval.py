"""Queries for metrics and model comparison (E0-E11, A3-A7, A14, V24) on the predictions fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions.presets import overfit_level_sql
from tabsmith.operators import compare as A
from tabsmith.operators import metrics as M
from tabsmith.plans import oracle_fixtures as OF
from tabsmith.plans.registry import query
from tabsmith.sources import fixtures as FX

PRED = OF.with_(OF.PREDICTIONS)
G = ["model"]


def _test(spark, sf):
    return FX.predictions(spark, sf).where(F.col("split") == "test")


def metric_ctes(where: str = "split = 'test'") -> str:
    return PRED.rstrip() + f""",
p AS (SELECT * FROM predictions WHERE {where}),
cnt AS (SELECT model, actual, predicted, count(*) AS n FROM p GROUP BY model, actual, predicted),
labels AS (SELECT DISTINCT model, l FROM (SELECT model, actual AS l FROM cnt UNION ALL SELECT model, predicted FROM cnt)),
cm AS (SELECT a.model, a.l AS actual, b.l AS predicted, coalesce(c.n, 0)::BIGINT AS n
       FROM labels a JOIN labels b ON a.model = b.model
       LEFT JOIN cnt c ON c.model = a.model AND c.actual = a.l AND c.predicted = b.l),
rws AS (SELECT model, actual AS class, sum(n) AS support, sum(CASE WHEN actual = predicted THEN n END) AS tp
        FROM cm GROUP BY model, actual),
cls AS (SELECT model, predicted AS class, sum(n) AS pred_n FROM cm GROUP BY model, predicted),
pc0 AS (SELECT r.model, r.class, CASE WHEN pred_n = 0 THEN 0.0 ELSE tp / pred_n END AS precision,
               CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, support::BIGINT AS support
        FROM rws r JOIN cls c ON r.model = c.model AND r.class = c.class),
pc AS (SELECT model, class, precision, recall,
              CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
              support FROM pc0),
tp_ AS (SELECT t.model, t.t, q.p FROM (SELECT model, actual AS c, sum(n) AS t FROM cm GROUP BY model, actual) t
        JOIN (SELECT model, predicted AS c, sum(n) AS p FROM cm GROUP BY model, predicted) q
        ON t.model = q.model AND t.c = q.c),
marg AS (SELECT model, sum(t * p)::DOUBLE AS sum_tp, sum(t * t)::DOUBLE AS sum_tt, sum(p * p)::DOUBLE AS sum_pp
         FROM tp_ GROUP BY model),
tot AS (SELECT model, sum(n)::DOUBLE AS s, sum(CASE WHEN actual = predicted THEN n END)::DOUBLE AS c
        FROM cm GROUP BY model),
ag AS (SELECT model, avg(CASE WHEN support > 0 THEN recall END) AS balanced_accuracy,
              avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
              sum(precision * support) / sum(support) AS precision_weighted,
              sum(recall * support) / sum(support) AS recall_weighted,
              sum(f1 * support) / sum(support) AS f1_weighted FROM pc GROUP BY model),
wide AS (SELECT tot.model, c / s AS accuracy, balanced_accuracy, precision_macro, recall_macro, f1_macro,
                precision_weighted, recall_weighted, f1_weighted,
                CASE WHEN 1 - sum_tp / (s * s) = 0 THEN 0.0 ELSE (c / s - sum_tp / (s * s)) / (1 - sum_tp / (s * s)) END
                  AS cohen_kappa,
                CASE WHEN sqrt((s * s - sum_pp) * (s * s - sum_tt)) = 0 THEN 0.0
                     ELSE (c * s - sum_tp) / sqrt((s * s - sum_pp) * (s * s - sum_tt)) END AS matthews_corrcoef
         FROM tot JOIN marg ON tot.model = marg.model JOIN ag ON ag.model = tot.model)"""


METRIC_COLS = ("accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
               "recall_weighted", "f1_weighted", "cohen_kappa", "matthews_corrcoef")


@query("confusion_matrix", metric_ctes() + "\nSELECT model, actual, predicted, n FROM cm")
def confusion_matrix(spark, sf):
    """E0."""
    return M.confusion_matrix(_test(spark, sf), G)


@query("confusion_normalised", metric_ctes() + """
SELECT model, actual, predicted, n, n / row_n AS share FROM (
  SELECT *, sum(n) OVER (PARTITION BY model, actual) AS row_n FROM cm) WHERE row_n > 0""", doubles=("share",))
def confusion_normalised(spark, sf):
    """E9 / V13."""
    return M.confusion_normalised(_test(spark, sf), G)


@query("per_class_metrics", metric_ctes() + "\nSELECT * FROM pc", doubles=("precision", "recall", "f1"))
def per_class_metrics(spark, sf):
    """E7."""
    return M.per_class(_test(spark, sf), G)


@query("metrics_wide", metric_ctes() + "\nSELECT * FROM wide", doubles=METRIC_COLS)
def metrics_wide(spark, sf):
    """E1-E6, E11."""
    return M.metrics_wide(_test(spark, sf), G)


@query("classification_report", metric_ctes() + """
SELECT model, CAST(class AS VARCHAR) AS "row", precision, recall, f1, support FROM pc
UNION ALL SELECT model, 'accuracy', avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END),
                 avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END),
                 avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), NULL::BIGINT FROM p GROUP BY model
UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM pc GROUP BY model
UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), sum(support)::BIGINT FROM pc GROUP BY model""",
       doubles=("precision", "recall", "f1"))
def classification_report(spark, sf):
    """E10."""
    return M.classification_report(_test(spark, sf), G)


@query("log_loss", metric_ctes() + f"""
SELECT model, -avg(ln(least(greatest(proba[actual + 1], {M.EPS!r}), {1 - M.EPS!r}))) AS log_loss FROM p GROUP BY model""",
       doubles=("log_loss",))
def log_loss(spark, sf):
    """E8."""
    return M.log_loss(_test(spark, sf), G)


_COMP = metric_ctes("true") .replace("p AS (SELECT * FROM predictions WHERE true)",
                                     "p AS (SELECT * FROM predictions WHERE split = 'test')") + """,
tr AS (SELECT model, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS train_accuracy
       FROM predictions WHERE split = 'train' GROUP BY model),
comp AS (SELECT w.model, accuracy, balanced_accuracy, f1_macro, f1_weighted, cohen_kappa, train_accuracy
         FROM wide w LEFT JOIN tr ON w.model = tr.model)"""


@query("comparison_table", _COMP + "\nSELECT * FROM comp",
       doubles=("accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "cohen_kappa", "train_accuracy"))
def comparison_table(spark, sf):
    """A3."""
    return A.comparison_table(FX.predictions(spark, sf))


@query("per_class_table", metric_ctes() + "\nSELECT * FROM pc", doubles=("precision", "recall", "f1"))
def per_class_table(spark, sf):
    """A4."""
    return A.per_class_table(FX.predictions(spark, sf))


@query("overfitting_levels", _COMP + f"""
SELECT model, train_accuracy, accuracy AS test_accuracy, train_accuracy - accuracy AS gap,
       (train_accuracy - accuracy) / (accuracy + 1e-8) AS gap_ratio, {overfit_level_sql('train_accuracy - accuracy')} AS level
FROM comp""", doubles=("train_accuracy", "test_accuracy", "gap", "gap_ratio"))
def overfitting_levels(spark, sf):
    """A6 / A7 (and V16's data)."""
    c = A.comparison_table(FX.predictions(spark, sf)).select(
        "model", "train_accuracy", F.col("accuracy").alias("test_accuracy"))
    return A.overfitting(c)


@query("best_model", _COMP + """
SELECT model AS best_model, accuracy FROM comp ORDER BY accuracy DESC, model LIMIT 1""", doubles=("accuracy",))
def best_model(spark, sf):
    """A14."""
    return A.best_model(A.comparison_table(FX.predictions(spark, sf)))


_FRIED = metric_ctes() + """,
rk AS (SELECT model, class, recall, rank() OVER (PARTITION BY class ORDER BY recall) AS r,
              count(*) OVER (PARTITION BY class, recall) AS t FROM pc),
rr AS (SELECT model, class, r + (t - 1) / 2.0 AS rnk FROM rk),
tie AS (SELECT sum(t * (t * t - 1)) AS ties FROM (SELECT class, recall, count(*) AS t FROM pc GROUP BY class, recall)),
rs AS (SELECT model, sum(rnk) AS R FROM rr GROUP BY model),
kn AS (SELECT count(DISTINCT model) AS k, count(DISTINCT class) AS n FROM pc),
st AS (SELECT k, n, CASE WHEN k >= 3 THEN
          (12.0 / (k * n * (k + 1)) * (SELECT sum(R * R) FROM rs) - 3 * n * (k + 1)) / (1 - ties / (k * (k * k - 1) * n))
        END AS statistic FROM kn, tie),
pv AS (SELECT *, (k - 1) / 2.0 AS a, statistic / 2.0 AS h FROM st)"""


# k = 3 models give 2 degrees of freedom; for an even number the tail is the finite sum exp(-h) * sum of h^i / i!, i < df / 2
@query("friedman_test", _FRIED + """,
tail AS (SELECT *, CASE WHEN statistic IS NULL THEN NULL WHEN statistic <= 0 THEN 1.0 WHEN (k - 1) % 2 = 0 THEN
           list_sum(list_transform(range(0, (k - 1) // 2), lambda i: exp(-h + i * ln(h) - lgamma(i + 1)))) END AS p FROM pv)
SELECT k::BIGINT AS n_models, n::BIGINT AS n_blocks, statistic, p AS p_value, p < 0.05 AS significant
FROM tail""", doubles=("statistic", "p_value"))
def friedman_test(spark, sf):
    """A5: Friedman test over per-class recalls of the three models."""
    pc = M.per_class(_test(spark, sf), G)
    return A.friedman(pc)


@query("rank_differences", _FRIED + """,
mr AS (SELECT model, avg(rnk) AS mean_rank FROM rr GROUP BY model)
SELECT a.model AS model_a, b.model AS model_b, a.mean_rank - b.mean_rank AS rank_diff
FROM mr a JOIN mr b ON a.model < b.model""", doubles=("rank_diff",))
def rank_differences(spark, sf):
    """V24 (re-aimed): pairwise mean-rank differences."""
    return A.rank_differences(M.per_class(_test(spark, sf), G))
