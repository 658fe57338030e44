"""Hand-computed unit cases (5-10 rows per operator)."""

import math

import pytest
from pyspark.sql import functions as F

from tabsmith.functions.parse import safe_double
from tabsmith.functions.presets import BEAN_CLASSES, NOISE_CONFIGS, variant_map
from tabsmith.operators import charts as V
from tabsmith.operators import clean as C
from tabsmith.operators import compare as A
from tabsmith.operators import features as FE
from tabsmith.operators import metrics as M
from tabsmith.operators import scale as S
from tabsmith.operators.quantile import quantiles, to_long


def test_variant_map_matches_original_size():
    m = dict(variant_map(BEAN_CLASSES))
    assert len(m) == 18
    assert m["D3RMAS0N"] == "DERMASON" and m["S3K3R"] == "SEKER" and m["sira"] == "SIRA"


def test_label_repair(spark):
    rows = [("DERMASON ",), ("sira",), ("S3K3R",), ("H0R0Z",), ("Sira",), ("C4LI",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    out = [(r.label, r.valid) for r in C.repair_labels(df, "c", BEAN_CLASSES).collect()]
    assert out == [("DERMASON", True), ("SIRA", True), ("SEKER", True), ("HOROZ", True),
                   ("Sira", False), ("C4LI", False), (None, False)]


def test_suffix_and_count(spark):
    df = spark.createDataFrame([("0.9293 cm",), ("0.9cm",), ("?",), ("",), (None,), ("0.5",)], "c string")
    vals = [r.c for r in C.parse_suffix(df, "c").collect()]
    assert vals == [0.9293, None, None, None, None, 0.5]
    assert C.suffix_count(df, ["c"]).first().affected_rows == 2


def test_safe_cast(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("1e3",), ("1d",), ("1.5f",), ("1_0",), ("nan",), ("0x10",)], "c string")
    assert [r[0] for r in df.select(safe_double(F.col("c"))).collect()] == [1.5, 1000.0, None, None, None, None, None]


@pytest.mark.parametrize("method", ["exact", "inmemory"])
def test_quantiles(spark, method):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,)], "x double")
    q = {r.prob: r.q for r in quantiles(to_long(df, ["x"]), [0.25, 0.5, 0.75], ["feature"], method=method).collect()}
    assert q == {0.25: 1.75, 0.5: 3.0, 0.75: 28.0}


def test_quantiles_refinement_path(spark):
    # force the refinement path with a tiny window limit
    df = spark.range(1000).select((F.col("id") * 1.0).alias("x"))
    q = quantiles(to_long(df, ["x"]), [0.25, 0.5, 0.9], ["feature"], window_rows=10, buckets=8)
    got = {r.prob: r.q for r in q.collect()}
    assert got == {0.25: 249.75, 0.5: 499.5, 0.9: 899.1}


def test_quantiles_of_null_group_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"), (F.col("id") * 1.0).alias("x"))
    long = to_long(df.unionByName(df.where("g = 'g1' AND x < 10").withColumn("g", F.lit("few"))), ["x"], ["g"])
    want = {(r.g, r.prob): r.q for r in quantiles(long, [0.25, 0.5], ["g", "feature"], method="inmemory").collect()}
    got = {(r.g, r.prob): r.q for r in quantiles(long, [0.25, 0.5], ["g", "feature"], window_rows=10, buckets=8).collect()}
    assert got == want and (None, 0.5) in got and ("few", 0.5) in got and len(got) == 8
    # a group with a NULL key that is small beside large ones
    long = long.where("g IS NOT NULL OR value < 20")
    got = {(r.g, r.prob): r.q for r in quantiles(long, [0.5], ["g", "feature"], window_rows=10, buckets=8).collect()}
    assert got[None, 0.5] == 9.0 and len(got) == 4


def test_quantiles_of_magnitudes_far_apart(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = 10.0 ** rng.uniform(-300, 300, 1500) * np.where(rng.random(1500) < 0.3, -1, 1)
    x = np.concatenate((x, np.full(900, 2.5e-7), [0.0, -0.0, 5e-324, 1e300, -1e300]))  # ties and the ends of the range
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r.prob: r.q for r in quantiles(to_long(df, ["x"]), probs, ["feature"], window_rows=10, buckets=16).collect()}
    s = np.sort(x)
    for p in probs:
        h = (len(s) - 1) * p
        lo, hi = s[int(np.floor(h))], s[int(np.ceil(h))]
        assert got[p] == lo + (h - np.floor(h)) * (hi - lo), p


def test_curves_in_score_ranges(spark):
    """One model and class hold all rows; ranges of some 20 scores give the curve of a single pass."""
    import numpy as np
    rng = np.random.default_rng(5)
    rows = [("m", int(rng.random() < 0.4), [0.0, float(rng.integers(0, 700)) / 700 * float(rng.random() < 0.8)])
            for _ in range(1500)]
    pred = spark.createDataFrame(rows, "model string, actual int, proba array<double>")
    want, tp, fp = {}, 0, 0
    for s in sorted({r[2][1] for r in rows}, reverse=True):
        before = (fp, tp)
        tp += sum(r[1] == 1 for r in rows if r[2][1] == s)
        fp += sum(r[1] != 1 for r in rows if r[2][1] == s)
        want[s] = (fp, tp, *before)
    for limit in (20, 10_000):
        pts = V.roc_points(pred, ["model"], 2, rows_per_range=limit)
        got = {r.threshold: r for r in pts.where("class = 1").collect()}
        assert got.keys() == want.keys()
        for s, (f, t, f0, t0) in want.items():
            assert (got[s].fpr, got[s].tpr, got[s].fpr_before, got[s].tpr_before) == (f / fp, t / tp, f0 / fp, t0 / tp)
            assert got[s].precision == t / (t + f)
    ranged = V._score_ranges(V._ovr_counts(pred, ["model"], 2, None), ["model", "class"], 20)
    sizes = [r["count"] for r in ranged.where("class = 1").groupBy("_range").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 60


def test_curve_tail_of_long_and_short_curves(spark):
    c = spark.range(130).selectExpr("'a' AS g", "id AS o").union(spark.range(100).selectExpr("'b' AS g", "id AS o"))
    got = {r.g: (r["n"], r.lo) for r in V.curve_tail(c, ["g"], "o").groupBy("g").agg(
        F.count("*").alias("n"), F.min("o").alias("lo")).collect()}
    assert got == {"a": (50, 80), "b": (100, 0)}


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,)], "x double")
    st = S.Scaler("standard", ["x"], []).fit(df).stats.first()
    assert abs(st.scale - 42.304698) < 1e-6


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    for m in ("standard", "minmax", "robust"):
        assert [r.x for r in S.scale(df, ["x"], m).collect()] == [0.0, 0.0, 0.0]


def test_robust_zero_iqr(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (9.0,), (1.0,), (1.0,)], "x double")
    assert [r.x for r in S.scale(df, ["x"], "robust").collect()] == [0.0, 0.0, 8.0, 0.0, 0.0]


def test_interaction_names():
    cols = [f"c{i}" for i in range(8)]
    names = FE.interaction_names(cols)
    assert len(names) == 28 and names[0][0] == "c0_x_c1" and names[-1][0] == "c6_x_c7"


def test_overfitting_levels(spark):
    df = spark.createDataFrame([("lr", 0.9071, 0.9010), ("knn", 1.0, 0.8955)],
                               "model string, train_accuracy double, test_accuracy double")
    out = {r.model: (round(r.gap, 4), r.level) for r in A.overfitting(df).collect()}
    assert out == {"lr": (0.0061, "Low"), "knn": (0.1045, "Severe")}


def test_overfit_thresholds(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal(x),) for x in ("0.0199", "0.02", "0.05", "0.10")], "g decimal(6,4)")
    levels = [r[0] for r in df.select(A.overfit_level(F.col("g"))).collect()]
    assert levels == ["Low", "Moderate", "High", "Severe"]


def test_noise_configs(spark):
    from tabsmith.operators.noise import noise_configs
    rows = noise_configs(spark).collect()
    assert len(rows) == 14 == len(NOISE_CONFIGS)
    kinds = [r.type for r in rows]
    assert kinds.count("gaussian") == 5 and kinds.count("salt_pepper") == 3
    assert kinds.count("label") == 4 and kinds.count("outlier") == 2


def test_chi2_tail(spark):
    df = spark.createDataFrame([(11.0705, 5), (3.0, 2)], "x double, df int")
    got = [r[0] for r in df.select(A.chi2_sf(F.col("x"), F.col("df"))).collect()]
    assert abs(got[0] - 0.05) < 1e-5 and abs(got[1] - math.exp(-1.5)) < 1e-9


def test_metrics_small(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 1), (2, 1)]
    df = spark.createDataFrame([("m", i, a, p) for i, (a, p) in enumerate(rows)],
                               "model string, row_id long, actual int, predicted int")
    w = M.metrics_wide(df, ["model"]).first()
    assert abs(w.accuracy - 4 / 6) < 1e-12
    # recalls: c0 2/3, c1 1, c2 0 -> balanced 5/9
    assert abs(w.balanced_accuracy - 5 / 9) < 1e-12
    cm = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(df, ["model"]).collect()}
    assert len(cm) == 9 and cm[(2, 2)] == 0 and cm[(2, 1)] == 1


def test_anova_matches_hand(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", 5.0)], "c string, x double")
    f = FE.anova_f(df, ["x"], "c").first().f_score
    # means 1.5, 4.5; grand 3; SSB = 2*2.25*2 = 9; SSW = 4*0.25 = 1; F = 9 / (1/2) = 18
    assert abs(f - 18.0) < 1e-12


def test_columns_with_double_underscores_survive(spark):
    from tabsmith.operators.impute import impute_knn, impute_median
    from tabsmith.operators.outliers import winsorize

    df = spark.createDataFrame([(i, float(i) if i % 3 else None, f"u{i}", 7.0, "s") for i in range(12)],
                               "row_id long, x double, user__id string, median__x double, _stats string")
    for out in (impute_median(df, ["x"]), winsorize(df, ["x"]), S.scale(df, ["x"]), impute_knn(df, ["x", "median__x"], "row_id", k=2)):
        assert out.columns == df.columns
        rows = out.orderBy("row_id").collect()
        assert [r["user__id"] for r in rows] == [f"u{i}" for i in range(12)] and {r["_stats"] for r in rows} == {"s"}
    assert [r.x for r in impute_median(df, ["x"]).orderBy("row_id").collect()][0] == 6.0


@pytest.mark.parametrize("x, df, want", [
    # fixed values: upper tails from tables of the distribution
    (50.0, 5, 1.3857e-9), (2.0, 2, math.exp(-1)), (600.0, 2, math.exp(-300)), (3.841458820694124, 1, 0.05),
    (11.070497693516351, 5, 0.05), (124.3421134, 100, 0.05), (77.9294652, 100, 0.95), (0.0, 3, 1.0)])
def test_chi2_tail(spark, x, df, want):
    got = spark.createDataFrame([(x, df)], "x double, df long").select(A.chi2_sf(F.col("x"), F.col("df")).alias("p")).first().p
    assert got == pytest.approx(want, rel=1e-4)


def test_chi2_far_tails(spark):
    rows = spark.createDataFrame([(600.0, 5), (700.0, 5), (1000.0, 5), (3000.0, 900)], "x double, df long")
    ps = [r.p for r in rows.select(A.chi2_sf(F.col("x"), F.col("df")).alias("p")).collect()]
    assert 0 <= ps[2] < 1e-200 and ps[2] <= ps[1] < ps[0] < 1e-100 and ps[3] < 1e-100


def test_metrics_on_huge_counts(spark):
    big = 4 * 10**9
    cm = spark.createDataFrame([("m", 0, 0, big), ("m", 1, 1, big), ("m", 0, 1, 1)], "model string, actual int, predicted int, n long")
    import tabsmith.operators.metrics as MM

    original = MM.confusion_counts
    MM.confusion_counts = lambda pred, grp: cm  # the counts that the metrics start from
    try:
        r = M.metrics_wide(cm, ["model"]).first()
    finally:
        MM.confusion_counts = original
    assert r.cohen_kappa == pytest.approx(1.0, abs=1e-6) and r.matthews_corrcoef == pytest.approx(1.0, abs=1e-6)


def test_small_values_keep_their_digits(spark):
    from tabsmith.plans.pipeline import round_doubles

    rows = [(3.8e-9,), (3.9e-9,), (1e-300,), (123456789.123456,), (None,), (0.0,)]
    got = [r.x for r in round_doubles(spark.createDataFrame(rows, "x double"), ("x",)).collect()]
    assert got == [3.8e-9, 3.9e-9, 1e-300, 123456789.1, None, 0.0]


def test_knn_ties_return_k_rows():
    import numpy as np
    from tabsmith.operators.knn import _topk_rows

    dist = np.array([[1.0, 1.0, 1.0, 1.0], [2.0, 1.0, np.nan, 1.0], [np.nan] * 4])
    donors = np.array([9, 3, 5, 1])
    qi, di = _topk_rows(dist, 2, donors)
    assert sorted(zip(qi.tolist(), donors[di].tolist())) == [(0, 1), (0, 3), (1, 1), (1, 3)]


def test_timing_summary_keeps_requested_batches(spark):
    rows = [("m", b, min(b, 90), r, 0.5) for b in (1, 100, 1000) for r in range(3)]
    got = A.timing_summary(spark.createDataFrame(rows, "model string, batch int, n_rows int, rep int, seconds double")).orderBy("batch").collect()
    assert [(r.batch, r.n_rows, r.rows_per_sec, r.short) for r in got] == [(1, 1, 2.0, False), (100, 90, 180.0, True), (1000, 90, 180.0, True)]


def test_noise_dispatch_and_imputation_dispatch(spark):
    from tabsmith.operators.impute import impute
    from tabsmith.operators.noise import apply_noise

    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(50)], "row_id long, label int, x double")
    for kind, param in (("gaussian", 20.0), ("salt_pepper", 50.0), ("outlier", 50.0)):
        out = apply_noise(df, ["x"], "label", "row_id", kind, param, 2).orderBy("row_id").collect()
        assert [r.label for r in out] == [i % 2 for i in range(50)] and any(r.x != i for i, r in enumerate(out))
    flipped = apply_noise(df, ["x"], "label", "row_id", "label", 10.0, 2).orderBy("row_id").collect()
    assert sum(r.label != r.row_id % 2 for r in flipped) == 5
    with pytest.raises(ValueError):
        apply_noise(df, ["x"], "label", "row_id", "pink", 1.0, 2)
    holes = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 5.0), (3, 3.0, 9.0)], "row_id long, x double, y double")
    assert [r.x for r in impute(holes, ["x"], "median").orderBy("row_id").collect()] == [1.0, 2.0, 3.0]
    assert [r.x for r in impute(holes, ["x", "y"], "knn", key="row_id", k=1).orderBy("row_id").collect()] == [1.0, 1.0, 3.0]
    with pytest.raises(ValueError):
        impute(holes, ["x"], "mode")


def test_checkpoint_folder_is_only_made_for_local_masters(monkeypatch):
    from tabsmith import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {"none": None}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_held_frames_are_released_and_a_callers_cache_stays(spark):
    from tabsmith.session import hold, release

    mine, held = spark.range(5).cache(), hold(spark.range(6))
    release()
    assert mine.is_cached and not held.is_cached
    mine.unpersist()
