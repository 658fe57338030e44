"""MLlib model contract on a small separable table (few iterations: contract, not quality)."""

from pyspark.sql import functions as F

from tabsmith.operators import models as ML


def _data(spark):
    rows = [(i, i % 2, float(i % 2) * 3 + (i % 7) * 0.1, float(i % 2) * -2 + (i % 5) * 0.1) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, label int, a double, b double")
    return df.where(F.col("row_id") < 40), df.where(F.col("row_id") >= 40)


def _check(pred):
    rows = pred.where(F.col("split") == "test").collect()
    assert len(rows) == 20
    for r in rows:
        assert r.predicted in (0, 1)
        assert abs(sum(r.proba) - 1.0) < 1e-9
    acc = sum(r.predicted == r.actual for r in rows) / len(rows)
    assert acc > 0.5  # beats the majority class on separable rows


def test_logistic(spark):
    tr, te = _data(spark)
    pred, model, _ = ML.fit_score("logistic", tr, te, ["a", "b"], "label", "row_id", params={"max_iter": 50})
    _check(pred)
    assert ML.importances(model, ["a", "b"], spark).count() == 2


def test_svm_fourier(spark):
    tr, te = _data(spark)
    pred, _, _ = ML.fit_score("svm", tr, te, ["a", "b"], "label", "row_id", params={"max_iter": 10})
    _check(pred)


def test_boosted_and_early_stop(spark):
    tr, te = _data(spark)
    pred, model, _ = ML.fit_score("boosted", tr, te, ["a", "b"], "label", "row_id", params={"n_estimators": 3})
    _check(pred)
    pred2, _, _ = ML.fit_score("boosted_leafwise", tr, te, ["a", "b"], "label", "row_id", val=te,
                               params={"n_estimators": 3})
    assert pred2.count() == 60


def test_forest_prefix_curve(spark):
    tr, te = _data(spark)
    _, model, _ = ML.fit_score("random_forest", tr, te, ["a", "b"], "label", "row_id",
                               params={"n_estimators": 10, "max_depth": 3})
    curve = {r.n_trees: r.accuracy for r in ML.tree_prefix_curve(model, te, [5, 10]).collect()}
    assert set(curve) == {5, 10} and curve[10] > 0.5


def test_a_comparison_fits_its_models_side_by_side(spark, monkeypatch):
    """Before, a model's fit waited for the one before it, so the barrier was never passed."""
    from threading import Barrier

    from tabsmith.plans import q_models as Q

    together = Barrier(len(ML.MODELS), timeout=20)
    monkeypatch.setattr(Q, "_splits", lambda *a: None)
    monkeypatch.setattr(Q, "fitted_model", lambda spark, sf, name, params=None: together.wait() >= 0 and name)
    monkeypatch.setattr(Q, "_pred", lambda spark, sf, name: spark.createDataFrame([(name,)], "model string"))
    assert [r.model for r in Q.all_predictions(spark, "none").collect()] == list(ML.MODELS)
