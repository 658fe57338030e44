"""Exact KNN: the tiled search against every pair, and what a search of many problems sends through the shuffle."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import knn as K
from tabsmith.operators import modeling as MD
from tabsmith.operators import robustness as R


def _by_pair(q, d, did, k, metric):
    dist = K._block_dist(q, d, metric, bool(np.isnan(q).any() or np.isnan(d).any()))
    return {(i, did[j], dist[i, j]) for i in range(len(q)) for j in sorted(np.flatnonzero(~np.isnan(dist[i])), key=lambda j: (dist[i, j], did[j]))[:k]}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("kind", ["normal", "ties", "offset", "spread", "huge"])
def test_tiles_give_the_rows_of_all_pairs(metric, kind):
    rng = np.random.default_rng(5)
    q, d = rng.normal(size=(300, 5)), rng.normal(size=(5000, 5))
    if kind == "ties":
        q, d = np.rint(q), np.rint(d)
    elif kind == "offset":
        q, d = q + 1e7, d + 1e7
    elif kind == "spread":
        q, d = q * [1e-3, 1, 1e3, 1e5, 1e-6], d * [1e-3, 1, 1e3, 1e5, 1e-6]
    elif kind == "huge":
        d[0], d[1], q[0] = 1e140, 1e160, 1e100
    cols, did = list("abcde"), rng.permutation(len(d)) * 3
    got = K._make_kernel(cols, 7, metric, [], None)(pd.DataFrame(q, columns=cols).assign(_qid=range(len(q))), pd.DataFrame(d, columns=cols).assign(_did=did))
    with np.errstate(over="ignore"):
        assert set(zip(got._qid, got._did, got.dist)) == _by_pair(q, d, did, 7, metric)


def test_missing_cells_give_the_rows_of_all_pairs():
    rng = np.random.default_rng(6)
    q, d = rng.normal(size=(200, 4)) * [1, 1e4, 1, 10], rng.normal(size=(4000, 4)) * [1, 1e4, 1, 10]
    q[rng.random(q.shape) < 0.4], d[rng.random(d.shape) < 0.1] = np.nan, np.nan
    cols, did = list("abcd"), rng.permutation(len(d))
    got = K._make_kernel(cols, 3, "euclidean", [], cols)(pd.DataFrame(q, columns=cols).assign(_qid=range(len(q))), pd.DataFrame(d, columns=cols).assign(_did=did))
    want = set()
    for c in range(4):
        need, have = np.flatnonzero(np.isnan(q[:, c])), np.flatnonzero(~np.isnan(d[:, c]))
        want |= {(need[i], c, j, x) for i, j, x in _by_pair(q[need], d[have], did[have], 3, "euclidean")}
    assert set(zip(got._qid, got.col, got._did, got.dist)) == want


def test_exact_distances_are_needed_for_few_pairs(monkeypatch):
    """Before, every coordinate of every pair was subtracted; now only pairs that may be among the nearest are."""
    seen = []
    whole = K._pair_dist
    monkeypatch.setattr(K, "_pair_dist", lambda q, d, qi, *rest: seen.append(len(qi)) or whole(q, d, qi, *rest))
    rng = np.random.default_rng(7)
    best = K._Best(256, 5, np.arange(20_000))
    K._search(rng.normal(size=(256, 16)), rng.normal(size=(20_000, 16)), np.arange(20_000), best, "euclidean", 1.0)
    assert 256 * 5 <= sum(seen) < 256 * 100


def test_problems_in_a_run_do_not_multiply_the_donors(spark, monkeypatch):
    """15 problems of 400 queries fit one block each, though all queries together would not."""
    def counting(cols, k, metric, by, *rest):
        return lambda q, d: pd.DataFrame({"g": d["g"].iloc[:1], "_qid": [0], "_did": [len(d)], "dist": [0.0]}) if len(d) else K._empty(by, False)

    monkeypatch.setattr(K, "_make_kernel", counting)
    rows = spark.range(6000).select((F.col("id") % 15).cast("int").alias("g"), "id", F.col("id").cast("double").alias("x"))
    found = K.knn_search(rows, rows, "id", ["x"], 1000, by=["g"], query_rows=400)
    assert found.agg(F.sum("did")).first()[0] == 6000


def _points(spark, n=120):
    return spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("y"), ((F.col("id") * 37) % 101 + (F.col("id") % 3) * 9).cast("double").alias("a"),
                                 ((F.col("id") * 53) % 97).cast("double").alias("b"))


def test_learning_curve_searches_once_for_all_sizes(spark, monkeypatch):
    asked = []
    search = K.knn_search
    monkeypatch.setattr(MD, "knn_search", lambda q, d, *a, **kw: asked.append((q.count(), d.count())) or search(q, d, *a, **kw))
    rows, sizes = _points(spark, 90), [0.5, 0.1, 1.0]
    got = MD.knn_learning_curve(rows, "id", ["a", "b"], "y", sizes, k=3, folds=3).orderBy("train_size").collect()
    assert asked == [(90, 180), (180, 180)]  # not three times as many
    # each size and fold on its own
    f = MD.stratified_folds(rows, "y", "id", k=3).cache()
    for r, size in zip(got, sorted(sizes)):
        train, val = [], []
        for fold in range(3):
            part = MD.class_rank(f.where(F.col("fold") != fold).withColumn("g", F.lit(0)), "g", "id", "lc", out="pos")
            part = part.where(F.col("pos") < int(size * 60)).select("id", "y", "a", "b").cache()
            for queries, out in ((f.where(F.col("fold") == fold).select("id", "y", "a", "b"), val), (part, train)):
                queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
                p = K.knn_classify(part, queries, "id", ["a", "b"], "y", k=3)
                out.append(p.join(queries, p.row_id == queries.id).agg(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0])
        assert r.train_size == int(size * 60)
        assert (r.train_mean, r.val_mean) == (pytest.approx(np.mean(train)), pytest.approx(np.mean(val)))


def test_flipped_labels_share_the_clean_search(spark, monkeypatch):
    copies = []
    search = R.knn_search
    monkeypatch.setattr(R, "knn_search", lambda q, d, *a, **kw: copies.append(d.select("noise_id").distinct().count()) or search(q, d, *a, **kw))
    rows = _points(spark)
    train, test = rows.where("id >= 30"), rows.where("id < 30")
    got = {r.noise_id: r.accuracy for r in R.knn_robustness(train, test, ["a", "b"], "y", "id", k=3).collect()}
    assert copies == [11] and sorted(got) == list(range(15))
    noisy = R.noisy_copies(train, ["a", "b"], "y", "id", 3)
    for i in (0, 2, 9, 12, 14):
        p = K.knn_classify(noisy.where(F.col("noise_id") == i), test, "id", ["a", "b"], "y", k=3, n_classes=3)
        own = p.join(test, p.row_id == test.id).agg(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0]
        assert got[i] == pytest.approx(own)


def test_a_grid_meets_each_pair_once_and_shuffles_no_copies(spark):
    """Before, every metric had a search of its own, and a query's neighbours were shuffled for each k and weighting."""
    rng = np.random.default_rng(9)
    x = np.rint(rng.normal(size=(120, 3)) * 2)
    df = spark.createDataFrame([(i, i % 3, *map(float, r)) for i, r in enumerate(x.tolist())], "row_id long, label int, a double, b double, c double")
    ks, weights, metrics = [1, 4], ["uniform", "distance"], ("euclidean", "manhattan")
    scores = MD.knn_grid_scores(df, "row_id", ["a", "b", "c"], "label", ks, weights, 3, metrics)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInPandas") == 1
    copies = [line for line in plan.split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning(" in line and "qid" in line and "k#" in line]
    assert copies == []
    got = {(r.k, r.weights, r.metric, r.fold): r.score for r in scores.collect()}
    folds = MD.stratified_folds(df, "label", "row_id", k=3)
    want = {}
    for fold in range(3):
        tr, te = folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)
        for m in metrics:
            for w in weights:
                for k in ks:
                    p = K.knn_classify(tr, te, "row_id", ["a", "b", "c"], "label", k=k, weights=w, metric=m)
                    want[k, w, m, fold] = MD.balanced_accuracy_by(p, te, "row_id", "label", ["k"]).first().score
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_fills_by_ranges_equal_all_pairs(spark, metric, monkeypatch):
    """Ranges of one column, dealt to several tasks where rows crowd, find the donors that all pairs find; before, every
    donor was copied for every block of queries."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(700):
        x = [float(np.round(v, 2)) for v in (rng.normal() * 100 if i % 3 else 7.0, rng.normal() * 5, rng.integers(0, 4), rng.normal())]
        for j in range(4):
            if rng.random() < (0.03, 0.1, 0.1, 0.05)[j]:
                x[j] = None if i % 2 else float("nan")
        rows.append((i // 2 if i < 20 else i, *x))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, e double").persist()
    cols = ["a", "b", "c", "e"]
    missing = df.where(" OR ".join(f"{c} IS NULL OR isnan({c})" for c in cols))
    for sought in (cols, ["b"]):
        want = K.knn_search(missing, df, "id", cols, 3, metric=metric, impute_cols=sought)
        copied, kernel = [], K._make_kernel
        monkeypatch.setattr(K, "_make_kernel", lambda *a: copied.append(a) or kernel(*a))
        got = K.knn_search(missing, df, "id", cols, 3, metric=metric, impute_cols=sought, query_rows=9, donor_rows=40)
        monkeypatch.undo()
        plain = lambda t: sorted((r.qid, r.col, r.rn, round(r.dist, 9), r.did) for r in t.collect())
        assert len(copied) == 1 and plain(got) == plain(want) and len(plain(want)) > 50
    empty = K.knn_search(missing.limit(0), df, "id", cols, 3, impute_cols=cols, donor_rows=40)
    assert empty.count() == 0
