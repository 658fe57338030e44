"""Forests (M4): the driver holds no tree, the trees depend on neither partitions nor chunks, and odd rows are kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import forest as FO
from tabsmith.operators import models as ML
from tabsmith.operators import tuning as TU

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = np.where(x[:, 0] + x[:, 1] > 0.3, 2, np.where(x[:, 2] > 0, 1, 0))
    return spark.createDataFrame([(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))], "row_id long, label int, a double, b double, c double").cache()


def _blobs(model, spark, forest=0):
    return {r.tree: bytes(r.nodes) for r in model.table(spark).where(F.col("forest") == forest).collect()}


def test_trees_depend_on_neither_partitions_nor_chunks(spark, table, monkeypatch):
    par = FO.Forest(trees=9, depth=8)
    rows = FO.problem_rows(table, COLS, "label", "row_id")
    one = FO.fit(rows.coalesce(1), {0: (0, par)}, 3)
    monkeypatch.setattr(FO, "CHUNK", 2)
    both = rows.unionByName(rows.withColumn("problem", F.lit(1)).where("key % 2 = 0")).repartition(5)
    two = FO.fit(both, {0: (0, par), 1: (1, par), 2: (0, FO.Forest(trees=3, depth=2))}, 3)
    assert _blobs(one, spark) == _blobs(two, spark) and len(_blobs(one, spark)) == 9
    assert len(two.files[0]) == 5 and len(_blobs(two, spark, 1)) == 9 and len(_blobs(two, spark, 2)) == 3


def test_the_model_on_the_driver_does_not_grow_with_the_rows(spark, table):
    fitted = ML.fit_model("random_forest", table, COLS, "label", "row_id", params={"n_estimators": 4})
    held = fitted.model
    assert set(vars(held)) == {"n_classes", "n_features", "n_bins", "cuts", "problems", "path", "files"}
    assert all(isinstance(uri, str) for uri in held.files[0])
    nodes = ML.forest_nodes(fitted, spark)
    assert nodes.select("tree").distinct().count() == 4
    assert nodes.where("abs(aggregate(votes, 0d, (s, v) -> s + v) - 1) > 1e-9").count() == 0
    assert abs(held.importances(spark).sum() - 1) < 1e-12


def test_cuts_are_the_best_of_all_cuts():
    rng = np.random.default_rng(0)
    for _ in range(30):
        bins, y = rng.integers(0, 6, 40), rng.integers(0, 3, 40)
        count, slot = rng.integers(1, 3, 40), np.sort(rng.integers(0, 4, 40))
        slot = np.unique(slot, return_inverse=True)[1]
        m, weight, par = slot.max() + 1, np.array([1.0, 2.0, 0.5]), FO.Forest(min_rows=2)
        total = np.stack([np.bincount(y[slot == s], count[slot == s], 3) for s in range(m)])
        few = FO._best_of_few(bins, slot, y, count, total, weight, par, 7)
        many = FO._best(FO._histogram(bins, slot, y, count, m, 7, 3), weight, par)
        for s in range(m):
            def score(cut):
                out = 0.0
                for side in (bins <= cut, bins > cut):
                    w = np.bincount(y[side & (slot == s)], count[side & (slot == s)], 3)
                    if w.sum() < 2:
                        return -np.inf
                    out += ((w * weight) ** 2).sum() / (w * weight).sum()
                return out
            want = max(map(score, range(7)))
            for found in (few, many):
                assert found[0][s] == pytest.approx(want) and (want == -np.inf or score(found[1][s]) == pytest.approx(want))
                left = (slot == s) & (bins <= found[1][s])
                assert want == -np.inf or (found[2][s] == np.bincount(y[left], count[left], 3)).all()


def test_repeated_and_null_keys_and_missing_values_keep_their_rows(spark, table):
    odd = table.unionByName(table.limit(50)).withColumn("row_id", F.when(F.col("label") > 0, F.col("row_id"))).withColumn(
        "a", F.when(F.col("b") < 1.5, F.col("a")))
    fitted = ML.fit_model("random_forest", odd, COLS, "label", "row_id", params={"n_estimators": 5, "max_depth": 6})
    pred = fitted.predict(odd, "x")
    assert pred.count() == 450 and pred.where("row_id is null").count() == odd.where("row_id is null").count()
    assert pred.where("abs(aggregate(proba, 0d, (s, v) -> s + v) - 1) > 1e-9").count() == 0
    with pytest.raises(Exception, match="null"):
        ML.fit_model("random_forest", odd.withColumn("label", F.when(F.col("label") > 0, F.col("label"))), COLS, "label", "row_id")


def test_a_predicting_task_meets_one_forest(spark, table):
    """Before, the rows of all forests lay mixed, so every task read every tree of every forest."""
    rows = FO.problem_rows(table, COLS, "label", "row_id")
    model = FO.fit(rows, {f: (0, FO.Forest(trees=3, depth=4, seed=f)) for f in range(5)}, 3)
    asked = rows.crossJoin(spark.range(5).select(F.col("id").cast("int").alias("forest"))).select("forest", F.col("forest").alias("f"), "x", "key")
    pred = model.predict(asked, ["f", "key"]).withColumn("part", F.spark_partition_id()).cache()
    assert pred.count() == 2000 and pred.groupBy("part").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
    for f in (0, 3):
        alone = FO.fit(rows, {0: (0, FO.Forest(trees=3, depth=4, seed=f))}, 3).predict(asked.where(F.col("forest") == f).withColumn("forest", F.lit(0)), ["key"])
        both = alone.select(F.col("key").alias("of"), F.col("proba").alias("own")).join(pred.where(F.col("f") == f), F.col("of") == F.col("key"))
        assert both.count() == 400 and both.where("own = proba").count() == 400


def test_forests_of_a_search_are_those_of_single_fits(spark, table):
    from tabsmith.operators.split import stratified_folds

    candidates = [{"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 2}, {"n_estimators": 2, "max_depth": None, "min_samples_leaf": 1}]
    got = {(r.params["n_estimators"], r.fold): (r.n, r.score) for r in TU.search("random_forest", table, COLS, "label", "row_id", candidates, 3).collect()}
    folds = stratified_folds(table, "label", "row_id", k=3)
    assert len(got) == 6
    for c in candidates:
        fitted = ML.fit_model("random_forest", folds.where("fold <> 1"), COLS, "label", "row_id", params=c)
        rows = fitted.predict(folds.where("fold = 1"), "x").collect()
        recall = [np.mean([r.predicted == y for r in rows if r.actual == y]) for y in range(3)]
        assert got[str(c["n_estimators"]), 1] == (len(rows), pytest.approx(np.mean(recall)))


def test_partitions_of_a_fit_do_not_grow_with_the_rows():
    assert [ML.frame_parts(n, 64, 12, 12) for n in (0, 7_400, 72_000, 430_000)] == [1, 1, 1, 1]
    assert [ML.frame_parts(n, 64, 1, 12) for n in (7_400, 72_000, 430_000)] == [1, 4, 12]
    assert ML.frame_parts(72_000, ML.mapped_width("svm", 30, {"kernel": "poly"}), 1, 12) == 13
    assert ML.mapped_width("svm", 30, {"kernel": "poly"}) == 5455 and ML.mapped_width("svm", 30) == 256


def test_a_limit_of_steps_that_was_not_reached_needs_no_fit_of_its_own(spark, table, monkeypatch):
    from pyspark.ml.classification import LogisticRegression

    real, limits = LogisticRegression._fit, []
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: limits.append(self.getMaxIter()) or real(self, df))
    space = {"C": [1.0], "max_iter": [2, 900, 1000]}
    got = {(r.params["max_iter"], r.fold): r.score for r in TU.search("logistic", table, COLS, "label", "row_id", TU.grid(space), 3).collect()}
    assert len(got) == 9 and sorted(limits) == [2] * 3 + [1000] * 3
    assert all(got["900", f] == got["1000", f] for f in range(3))
