"""The joint SVM fit: its maps by brute force, its objective against MLlib's, and one job a step for all classes."""

from itertools import combinations_with_replacement

import numpy as np
import pytest

from tabsmith.operators import models as ML
from tabsmith.operators import svm as SV

COLS = ["a", "b", "c"]


def _rows(n=240, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, 3))
    y = (x[:, 0] * x[:, 1] > 0.2).astype(int) + (x[:, 2] > 0.8)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = _rows()
    rows = [(i, int(c), *map(float, r)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, label int, a double, b double, c double").coalesce(2)


@pytest.mark.parametrize("degree", [1, 2, 3, 4])
def test_monomials_by_brute_force(degree):
    x = np.random.default_rng(degree).normal(size=(17, 4))
    of = [m for d in range(1, degree + 1) for m in combinations_with_replacement(range(4), d)]
    want = np.stack([np.prod(x[:, list(m)], axis=1) for m in of], axis=1)
    m = SV.Monomials(4, degree)
    rng = np.random.default_rng(0)
    w, r = rng.normal(size=(3, len(of))), rng.normal(size=(17, 3))
    assert m.width == len(of) == ML.mapped_width("svm", 4, {"kernel": "poly", "degree": degree})
    assert np.allclose(m.rows(x), want)
    assert np.allclose(m.margins(m.opened(x), w), want @ w.T) and np.allclose(m.sums(m.opened(x), r), r.T @ want)


@pytest.mark.parametrize("params", [{"kernel": "linear"}, {"kernel": "poly"}, {"kernel": "rbf", "n_components": 40}])
def test_objective_is_as_low_as_mllibs(spark, table, params):
    from pyspark.sql import functions as F

    n = table.count()
    ours = ML.fit_model("svm", table, COLS, "label", "row_id", params=params).model
    weighted = ML.with_balanced_weight(ML.assemble(table, COLS), "label").withColumn("label_d", F.when(F.col("label") == 0, 1.0).otherwise(0.0))
    spec = ML.build("svm", 3, float(n), params, 3)
    theirs = spec.estimator.getClassifier().setLabelCol("label_d").fit(spec.pre.transform(weighted) if spec.pre else weighted)
    x, y = _rows()
    z, w = SV.feature_map(3, params).rows(x), n / (3 * np.bincount(y)[y])
    std = np.sqrt(w @ (z - w @ z / w.sum()) ** 2 / (w.sum() - w @ w / w.sum()))
    margin = z @ ours.coefs[0] + ours.intercepts[0]
    loss = w @ np.maximum(0, 1 - np.where(y == 0, 1, -1) * margin) / w.sum() + 0.5 / (10 * n) * ((ours.coefs[0] * std) ** 2).sum()
    assert loss < theirs.summary().objectiveHistory[-1] * 1.02 + 1e-3


def test_a_step_of_all_classes_is_one_job(spark, table):
    """Before, each class took its own steps, each a job."""
    sc, steps = spark.sparkContext, 20
    sc.setJobGroup("svm-steps", "")
    try:
        fitted = ML.fit_model("svm", table, COLS, "label", "row_id", params={"kernel": "poly", "max_iter": steps}, n_classes=3)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("svm-steps")) < 2 * steps + 12
    right = fitted.predict(table, "train").where("predicted = actual").count()
    assert right > 200


def test_blocks_partitions_and_missing_classes_do_not_matter(spark, table):
    one = ML.svm_blocks(table, COLS, "label", 1)[0]
    many = SV.blocks(SV.rows_of(ML.with_balanced_weight(table, "label"), COLS, "label").repartition(40))  # some are empty
    assert many.getNumPartitions() == 40
    a, b = (SV.fit(k, SV.Columns(3), 4, 0.01, steps=3) for k in (one, many))  # no row has label 3
    assert np.allclose(a.coefs, b.coefs) and np.allclose(a.intercepts, b.intercepts) and len(a.coefs) == 4


def test_unknown_kernel_raises():
    with pytest.raises(ValueError, match="unknown kernel"):
        SV.feature_map(3, {"kernel": "sigmoid"})
