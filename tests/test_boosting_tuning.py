"""Boosting, searches, robustness, the state store and CSV headers on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import boosting as B
from tabsmith.operators import models as ML
from tabsmith.operators import noise as N
from tabsmith.operators import robustness as R
from tabsmith.operators import tuning as TU
from tabsmith.sources import io, store


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 3))
    y = np.where(x[:, 0] + x[:, 1] > 0.5, 2, np.where(x[:, 0] > 0, 1, 0))
    rows = [(i, int(y[i]), float(x[i, 0]), float(x[i, 1]), None if i % 29 == 0 else float(x[i, 2])) for i in range(240)]
    return spark.createDataFrame(rows, "row_id long, label int, a double, b double, c double").persist()


COLS = ["a", "b", "c"]


def _rows(df, problem=None):
    return B.problem_rows(df, COLS, "label", "row_id", F.when(F.col("row_id") % 4 == 0, B.VAL).otherwise(B.TRAIN), problem)


def test_best_split_equals_brute_force():
    rng = np.random.default_rng(0)
    p = B.Boost(lam=1.0, min_rows=3, min_hessian=0.0)
    for _ in range(20):
        n, d, bins = 40, 3, 6
        cells, g, h = rng.integers(0, bins, (n, d)), np.rint(rng.normal(size=n) * B.SCALE), np.rint(rng.random(n) * B.SCALE)
        hist = np.zeros((3, d, bins))
        for f in range(d):
            for k, w in enumerate((g, h, np.ones(n))):
                np.add.at(hist[k, f], cells[:, f], w)
        score = lambda m: (g[m].sum() / B.SCALE) ** 2 / (h[m].sum() / B.SCALE + 1.0)
        every = np.ones(n, bool)
        best = max(((0.5 * (score(cells[:, f] <= b) + score(cells[:, f] > b) - score(every)), -f, -b)
                    for f in range(d) for b in range(bins - 1)
                    if min((cells[:, f] <= b).sum(), (cells[:, f] > b).sum()) >= 3), default=(0, 0, 0))
        gain, f, b, _, _ = B.best_split(hist, p, np.ones(d, bool))
        assert (abs(gain - best[0]) < 1e-9 and (f, b) == (-best[1], -best[2])) if best[0] > 1e-9 else f == -1


def test_trees_depend_on_neither_partitions_nor_company(table, monkeypatch):
    par = B.Boost(rounds=4, depth=3)
    one = B.fit(_rows(table), {0: par}, 3)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 50)
    spread = B.fit(_rows(table.repartition(5)), {0: par}, 3)
    assert one.trees[0] == spread.trees[0] and one.curve == spread.curve
    monkeypatch.undo()
    two = table.crossJoin(table.sparkSession.range(2).select(F.col("id").alias("p")))
    both = B.fit(_rows(two, F.col("p")), {0: B.Boost.leafwise(rounds=2, min_rows=5), 1: par}, 3)
    assert both.trees[1] == one.trees[0] and len(both.trees[0]) == 2


@pytest.mark.parametrize("par", [B.Boost(depth=5, min_rows=2), B.Boost.leafwise(leaves=20, min_rows=4)])
def test_a_tree_sums_the_smaller_sibling_alone(par, monkeypatch):
    """Same tree as from histograms of every node, and fewer rows are summed; many rows go feature by feature."""
    rng = np.random.default_rng(8)
    bins, y = rng.integers(0, 9, (3000, 6)).astype(np.uint8), rng.random(3000)
    proba, own = np.clip(y * 0.8 + 0.1, 0, 1), (bins[:, 2] + bins[:, 4] > 8) & (y > 0.2)
    allowed = np.array([False, True, True, True, True, True])
    every, n_rows = B._Growing(par, allowed), 0
    while True:
        part = B._histograms(every.tree.arrays(), np.array(every.pending), bins, proba, own, 10)
        n_rows += int(part[2, :, 0].sum())
        for i, node in enumerate(every.pending):
            every.learn(node, B.best_split(part[:, i], par, allowed) if part[2, i].any() else B.NOTHING)
        if not every.plan():
            break
    summed, sums = [], B._sums
    monkeypatch.setattr(B, "_sums", lambda b, *rest: summed.append(len(b)) or sums(b, *rest))
    tree = B._whole_tree(par, allowed, bins, proba, own, 10)
    assert tree == every.finish() and len(tree.feature) > 15
    assert sum(summed) < 0.7 * n_rows
    leaves = B.route(tree.arrays(), bins)
    monkeypatch.setattr(B, "MANY_ROWS", 0)
    assert (B.route(tree.arrays(), bins) == leaves).all()
    monkeypatch.setattr(B, "FEW_CELLS", 0)
    assert B._whole_tree(par, allowed, bins, proba, own, 10) == tree


def test_leaf_limit_patience_missing_and_empty(table):
    m = B.fit(_rows(table), {0: B.Boost.leafwise(rounds=60, leaves=4, min_rows=5, rate=0.8, patience=3), 1: B.Boost(rounds=2)}, 3)
    assert all(sum(f < 0 for f in t.feature) <= 4 for classes in m.trees[0] for t in classes)
    val = [loss for p, _, s, loss, _ in m.curve if p == 0 and s == "val"]
    assert m.best[0] == int(np.argmin(val)) + 1 and len(m.trees[0]) in (60, m.best[0] + 3)
    pred = m.predict(_rows(table).withColumn("problem", F.lit(0)), ["label"]).collect()
    assert all(abs(sum(r.proba) - 1) < 1e-9 and r.predicted == int(np.argmax(r.proba)) for r in pred)
    assert np.mean([r.predicted == r.label for r in pred]) > 0.8
    empty = m.predict(_rows(table).limit(2).withColumn("problem", F.lit(1)), ["label"]).collect()
    assert all(max(r.proba) - min(r.proba) < 1e-12 for r in empty)  # problem 1 had no rows


@pytest.mark.parametrize("name, params", [("logistic", {"max_iter": 20}), ("svm", {"kernel": "rbf", "max_iter": 5}),
                                          ("random_forest", {"n_estimators": 5, "max_depth": 4}), ("boosted", {"n_estimators": 3}),
                                          ("knn", {"n_neighbors": 3})])
def test_saved_models_predict_as_before(table, name, params, tmp_path):
    full = table.na.fill(0.0)
    fitted = ML.fit_model(name, full, COLS, "label", "row_id", params=params)
    store.save_model(fitted, table.sparkSession, str(tmp_path))
    back = store.load_model(table.sparkSession, str(tmp_path))
    assert store.same_rows(fitted.predict(full, "x"), back.predict(full, "x"))
    assert fitted.predict(full, "x").where("predicted = actual").count() > 120


def test_search_scores_and_best(table):
    full = table.na.fill(0.0)
    scores = TU.search("logistic", full, COLS, "label", "row_id", TU.grid({"C": [0.1, 10], "solver": ["lbfgs", "saga"], "max_iter": [50]}), 3, 4)
    rows = scores.collect()
    assert len(rows) == 12 and {r.fold for r in rows} == {0, 1, 2} and sum(r.n for r in rows) == 4 * 240
    by = {(r.params["C"], r.params["solver"], r.fold): r.score for r in rows}
    assert all(by[c, "lbfgs", f] == by[c, "saga", f] and by[c, "lbfgs", f] > 0.6 for c, _, f in by)
    best = TU.best_params(scores).first()
    means = {c: np.mean([by[c, "lbfgs", f] for f in range(3)]) for c in ("0.1", "10")}
    assert abs(best.mean_score - max(means.values())) < 1e-12
    boosted = TU.search("boosted", full, COLS, "label", "row_id", TU.draws(table.sparkSession, {"n_estimators": [2, 3], "max_depth": [2]}, 2), 3)
    assert boosted.count() == 6 and boosted.agg(F.min("score")).first()[0] > 0.5
    knn = TU.search("knn", full, COLS, "label", "row_id", TU.grid({"n_neighbors": [3], "weights": ["uniform"], "metric": ["minkowski"], "p": [1, 2]}), 3)
    assert knn.count() == 6
    every = TU.tune_all(full, COLS, "label", "row_id", {"logistic": ("grid", {"C": [1.0]}, 0), "boosted": ("random", {"n_estimators": [2]}, 1)}, 3)
    assert {r.model for r in every.select("model").distinct().collect()} == {"logistic", "boosted"}


def test_noisy_copies_equal_apply_noise(table):
    full = table.na.fill(0.0)
    copies = R.noisy_copies(full, COLS, "label", "row_id", 3)
    for r in R.settings(table.sparkSession).where("noise_id in (2, 7, 10, 14)").collect():
        want = N.apply_noise(full, COLS, "label", "row_id", r.type, r.param, 3, r.noise_id)
        got = copies.where(F.col("noise_id") == r.noise_id).drop("noise_id")
        rounded = lambda df: df.select("row_id", "label", *[F.round(c, 9).alias(c) for c in COLS])
        assert store.same_rows(rounded(got), rounded(want))


def test_a_failed_setting_is_null(table, monkeypatch):
    full, real = table.na.fill(0.0), ML.fit_model
    calls = []

    def fails(name, train, *a, **k):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("no fit")
        return real(name, train, *a, **k)

    monkeypatch.setattr(ML, "fit_model", fails)
    rows = R.robustness("logistic", full, full, COLS, "label", "row_id", {"max_iter": 5}).collect()
    assert len(rows) == 15 and sum(r.accuracy is None for r in rows) == 1


def test_a_failed_job_is_no_result(table, monkeypatch):
    """A Spark job that fails, or a clean copy without a fit, ends the run; its query gives no table with holes."""
    from py4j.protocol import Py4JError

    from tabsmith.plans import q_models as Q

    full, real = table.na.fill(0.0), ML.fit_model

    def fails_with(error, clean):
        def fails(name, train, *a, **k):
            if (train.exceptAll(full).isEmpty()) == clean:
                raise error
            return real(name, train, *a, **k)
        return fails

    run = lambda: R.mllib_robustness("logistic", full, full, COLS, "label", "row_id", {"max_iter": 2})
    monkeypatch.setattr(R, "settings", lambda spark, every=R.settings: every(spark).where("noise_id in (0, 6)"))
    for error, clean in ((Py4JError("a lost executor"), False), (RuntimeError("no fit"), True)):
        monkeypatch.setattr(ML, "fit_model", fails_with(error, clean))
        with pytest.raises(type(error)):
            run()
    monkeypatch.setattr(ML, "fit_model", fails_with(ValueError("no fit"), False))
    rows = {r.noise_id: r.accuracy for r in run().collect()}
    assert rows[0] is not None and rows[6] is None
    monkeypatch.setattr(Q, "_splits", lambda spark, sf: (full.withColumn("split", F.lit("x")),) * 3)
    monkeypatch.setattr(Q, "VEC", COLS)
    with pytest.raises(RuntimeError, match="no score for"):
        Q._robust(table.sparkSession, "a folder", "logistic")


def test_csv_header_with_quotes_bom_and_blanks(spark, tmp_path):
    text = "\ufeffarea, \"a,b\" ,class\r\n1,\" x, \"\"y\"\"\",SIRA \r\n?,,\r\n"
    for split in ("train", "test", "val"):
        (tmp_path / f"{split}.csv").write_text(text.replace(' "a,b" ', '"a,b "'), encoding="utf-8")
    df = io.load_splits(spark, {s: str(tmp_path / f"{s}.csv") for s in ("train", "test", "val")})
    assert df.columns == ["area", "a,b", "class", "split"] and {t for _, t in df.dtypes} == {"string"}
    rows = df.where("split = 'val'").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("1", ' x, "y"', "SIRA ", "val"), ("?", None, None, "val")], key=str)


def test_balanced_accuracy_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 2.0)], "label_d double, prediction double")
    assert abs(TU.BalancedAccuracy().evaluate(df) - (0.5 + 1 + 1) / 3) < 1e-12
    assert np.isnan(TU.BalancedAccuracy().evaluate(df.limit(0)))


def test_sums_of_many_rows_are_exact():
    """Hessians and counts share a number within a chunk; sums over several chunks, at the largest values, stay exact."""
    rng = np.random.default_rng(3)
    n, slots, n_bins = 2 * B.CHUNK + 77, 3, 5
    bins, slot = rng.integers(0, n_bins, (n, 4)).astype(np.uint8), rng.integers(0, slots, n)
    g, h = rng.integers(-(1 << 24), (1 << 24) + 1, n).astype(float), np.where(rng.random(n) < 0.5, float(1 << 23), 0.0)
    for rows in (slice(0, 50), slice(0, n), slice(0, 0)):
        got = B._sums(bins[rows], slot[rows], g[rows], h[rows], slots, n_bins)
        for s in range(slots):
            for f in range(4):
                for b in range(n_bins):
                    at = (slot[rows] == s) & (bins[rows, f] == b)
                    assert got[:, s, f, b].tolist() == [g[rows][at].sum(), h[rows][at].sum(), at.sum()]


def test_nodes_that_no_cut_can_split_are_not_summed(monkeypatch):
    """Before, a histogram was made of every node above full depth, also of those with too few rows for two sides."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 8, (400, 3)).astype(np.uint8), rng.integers(0, 2, 400)
    par = B.Boost.leafwise(leaves=30, min_rows=60)
    searched, best = [], B.best_split
    monkeypatch.setattr(B, "best_split", lambda hist, *rest: searched.append(hist[2, 0].sum()) or best(hist, *rest))
    tree = B._whole_tree(par, np.ones(3, bool), x, np.full(400, 0.5), y == 1, 9)
    assert len(tree.feature) > 1 and min(searched) >= 120


@pytest.mark.parametrize("par", [B.Boost(rounds=6, depth=4), B.Boost.leafwise(rounds=30, leaves=6, min_rows=5, rate=0.8, patience=2)])
def test_classes_side_by_side_grow_the_same_trees(table, par, monkeypatch):
    """One task, a task per class, and a job per level: the same trees, losses and last round."""
    one = B.fit(_rows(table), {0: par}, 3)
    monkeypatch.setattr(B, "SHARE_ROWS", 10)
    asked, found = [], B._whole_rounds
    monkeypatch.setattr(B, "_whole_rounds", lambda problems, shares, *rest: asked.append(shares) or found(problems, shares, *rest))
    shared = B.fit(_rows(table.repartition(3)), {0: par}, 3)
    assert asked == [3] and shared.trees == one.trees and shared.curve == one.curve and shared.best == one.best
    monkeypatch.setattr(B, "slots", lambda spark: 2)  # fewer cores than classes
    assert B.fit(_rows(table), {0: par}, 3).trees == one.trees and asked == [3, 2]
    monkeypatch.setattr(B, "WHOLE", 0)
    levels = B.fit(_rows(table), {0: par}, 3)
    n = len(levels.trees[0])
    assert levels.trees[0] == one.trees[0][:n] and levels.curve == one.curve and levels.best == one.best and len(asked) == 2


def test_each_problem_has_a_task_and_all_rounds_a_job(table, monkeypatch):
    """Before, problems were dealt to tasks by their hash, several to one, and ten rounds were a job."""
    copies = table.crossJoin(table.sparkSession.range(6).select(F.col("id").alias("p")))
    seen, run = [], B._whole_rounds
    table.sparkSession.sparkContext.setJobGroup("rounds", "rounds")
    monkeypatch.setattr(B, "_whole_rounds", lambda *a: seen.append(a) or run(*a))
    model = B.fit(_rows(copies, F.col("p")), {p: B.Boost(rounds=23, depth=2) for p in range(6)}, 3)
    assert len(seen) == 1 and all(len(model.trees[p]) == 23 and model.trees[p] == model.trees[0] for p in range(6))


@pytest.mark.parametrize("rows", [40, 900, 40_000])
def test_running_sums_equal_plain_ones(rows, monkeypatch):
    """Counting two features at a time, or a row in all its cells, sums exactly what one count per feature does."""
    rng = np.random.default_rng(5)
    bins, use = rng.integers(0, 7, (50_000, 5)).astype(np.uint8), np.array([0, 1, 4])
    g, h = rng.integers(-(1 << 24), (1 << 24) + 1, 50_000).astype(float), rng.integers(0, (1 << 23) + 1, 50_000).astype(float)
    at, columns = np.sort(rng.choice(50_000, rows, False)), B._Columns(bins, 7)
    want = B._sums(bins[at], np.zeros(rows, np.int64), g[at], h[at], 1, 7)[:, 0][:, use].cumsum(axis=2)
    for few in (0, 10 ** 9) if rows < B.CHUNK else (0,):
        monkeypatch.setattr(B, "PAIR_ROWS", few)
        assert (columns.sums(use, at, g, h) == want).all()
