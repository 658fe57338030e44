"""The six classifiers behind one contract (M1-M6, A1, T1), their curves, importances and facts, and PCA (V6).

``fit_model`` fits one by name and returns a ``Fitted``, whose ``predict`` gives the prediction table
``(model, split, row_id, actual, predicted, proba)`` that all metric operators consume. Logistic regression is MLlib's
estimator configured like the original model. The SVM is one-vs-rest on the raw columns (linear), their products of up to
three (poly) or a random-Fourier map (rbf); ``operators.svm`` fits its classes together. KNN is the exact search of
``operators.knn``. Both boosted models are the softmax boosting of ``operators.boosting``; the forest
is ``operators.forest``, since MLlib's lies whole on the driver.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import PCA, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.presets import SEED
from tabsmith.operators import boosting as BO
from tabsmith.operators import forest as FO
from tabsmith.operators import knn as K
from tabsmith.operators import svm as SV
from tabsmith.operators.metrics import EPS
from tabsmith.operators.scale import class_weights
from tabsmith.session import ensure_checkpoint_dir, hold, in_threads

MODELS = ("logistic", "knn", "svm", "random_forest", "boosted", "boosted_leafwise")
BOOSTED = ("boosted", "boosted_leafwise")
ROWS_PER_PARTITION = 20_000
CELLS_PER_PARTITION = 32_000_000  # 256 MB of doubles
CELLS_PER_TASK = 4_000_000  # mapped values that are worth a task in a step of the SVM


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def frame_parts(n: int, width: int, fits: int, cores: int) -> int:
    """Partitions of a training table of ``n`` rows and ``width`` columns while ``fits`` optimizers run side by side.

    A step of an optimizer is a job, and each of its tasks answers the driver. So a table gets no more partitions than its
    fit has cores, however many rows there are, unless a partition would hold over ``CELLS_PER_PARTITION`` values."""
    return max(1, min(-(-n // ROWS_PER_PARTITION), -(-cores // fits)), -(-n * width // CELLS_PER_PARTITION))


def fit_frame(df: DataFrame, width: int = 64, fits: int = 1) -> DataFrame:
    """Keep a training table in as many partitions as its counted rows and the fits at a time need."""
    n = df.count()
    parts = frame_parts(n, width, fits, df.sparkSession.sparkContext.defaultParallelism)
    return hold(df.coalesce(parts) if parts <= max(1, n // ROWS_PER_PARTITION) else df.repartition(parts))


def mapped_width(name: str, n_features: int, params: dict | None = None) -> int:
    """Columns that the model's optimizer sees."""
    p = params or {}
    if name == "svm" and p.get("kernel", "rbf") == "rbf":
        return p.get("n_components", 256)
    if name == "svm" and p["kernel"] == "poly":
        return math.comb(n_features + p.get("degree", 3), n_features) - 1
    return n_features


def with_balanced_weight(df: DataFrame, label: str) -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias("w"))
    return df.join(w, label, "left")


class FourierFeatures(Transformer):
    """Random Fourier features for the RBF kernel (Rahimi & Recht 2007):
    z(x) = sqrt(2/D) · cos(W x + b), W ~ N(0, 2·gamma), b ~ U(0, 2π). W is a small
    (D x d) matrix fixed by the seed; rows are mapped in Arrow batches."""

    def __init__(self, n_features: int, gamma: float, n_components: int = 256, seed: int = SEED,
                 input_col: str = "features", output_col: str = "mapped"):
        super().__init__()
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, n_features))
        self.b = rng.uniform(0.0, 2 * math.pi, size=n_components)
        self.input_col, self.output_col = input_col, output_col

    def _transform(self, df: DataFrame) -> DataFrame:
        w, b, scale = self.w, self.b, math.sqrt(2.0 / self.w.shape[0])
        arr = df.withColumn("_x", vector_to_array(self.input_col))
        out_schema = T.StructType(arr.schema.fields + [T.StructField(self.output_col + "_arr",
                                                                      T.ArrayType(T.DoubleType()))])

        def fn(batches):
            for pdf in batches:
                x = np.stack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, w.shape[1]))
                z = scale * np.cos(x @ w.T + b)
                pdf[self.output_col + "_arr"] = list(z)
                yield pdf

        mapped = arr.mapInPandas(fn, out_schema)
        return mapped.withColumn(self.output_col, array_to_vector(self.output_col + "_arr")).drop(
            "_x", self.output_col + "_arr")


@dataclass
class Spec:
    name: str
    estimator: object
    pre: Transformer | None = None


def build(name: str, n_features: int, n_train: float, params: dict | None = None, n_classes: int = 2) -> Spec:
    """MLlib estimator of a model with the original's defaults; ``params`` has the original's parameter names."""
    p = dict(params or {})
    if name == "logistic":
        # every solver name of the original's grid finds the same optimum; MLlib's is L-BFGS
        est = LogisticRegression(family="multinomial", regParam=1.0 / (p.get("C", 1.0) * n_train), elasticNetParam=0.0,
                                 standardization=False, maxIter=p.get("max_iter", 3000), tol=p.get("tol", 1e-8), weightCol="w",
                                 featuresCol="features", labelCol="label_d")
        return Spec(name, est)
    if name == "svm":
        kernel, gamma = p.get("kernel", "rbf"), p.get("gamma", "scale")
        if kernel not in ("rbf", "poly", "linear"):
            raise ValueError(f"unknown kernel {kernel!r}; use 'rbf', 'poly' or 'linear'")
        # 'scale' and 'auto' agree on standardised columns
        gamma = 1.0 / n_features if gamma in ("scale", "auto") else float(gamma)
        pre, source = None, "features"
        if kernel == "rbf":
            pre, source = FourierFeatures(n_features, gamma, n_components=p.get("n_components", 256)), "mapped"
        elif kernel == "poly":
            pre, source = PolynomialExpansion(degree=p.get("degree", 3), inputCol="features", outputCol="mapped"), "mapped"
        # each step is a Spark job, and on the hinge loss steps beyond some tens hardly change the margins
        svc = LinearSVC(regParam=1.0 / (p.get("C", 10.0) * n_train), maxIter=p.get("max_iter", 50), tol=p.get("tol", 1e-3),
                        weightCol="w", featuresCol=source)
        est = OneVsRest(classifier=svc, featuresCol=source, labelCol="label_d", weightCol="w", parallelism=min(n_classes, 8))
        return Spec(name, est, pre)
    raise ValueError(f"unknown model {name!r}; use one of {MODELS}")


def boost_params(name: str, params: dict | None = None) -> BO.Boost:
    """The boosted models' parameters from the original's names; those it does not know raise."""
    names = {"n_estimators": "rounds", "max_depth": "depth", "learning_rate": "rate", "subsample": "subsample",
             "colsample_bytree": "colsample", "gamma": "gamma", "reg_alpha": "alpha", "reg_lambda": "lam",
             "num_leaves": "leaves", "min_child_samples": "min_rows", "early_stopping_rounds": "patience"}
    params = {k: v for k, v in (params or {}).items() if k != "class_weight"}
    if unknown := set(params) - set(names):
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    own = {names[k]: v for k, v in params.items()}
    if name == "boosted_leafwise":
        own.pop("subsample", None)  # the original's library draws rows only with a second parameter, which nobody sets
        return BO.Boost.leafwise(**own)
    return BO.Boost(**own)


def forest_params(params: dict | None = None) -> FO.Forest:
    """The forest's parameters from the original's names, with its defaults."""
    p = params or {}
    return FO.Forest(trees=p.get("n_estimators", 200), depth=min(p.get("max_depth", 20) or 30, 30),
                     min_rows=max(p.get("min_samples_leaf", 1), 1))


@dataclass
class Fitted:
    """A fitted classifier: ``model`` is MLlib's, a ``Booster`` (its problem 0), ``Forests`` (its forest 0), a ``Machine``, or for KNN the training rows."""

    name: str
    model: object
    cols: list[str]
    label: str
    key: str
    spec: Spec | None = None
    seconds: float = 0.0
    params: dict | None = None
    n_classes: int = 0

    def predict(self, df: DataFrame, split: str) -> DataFrame:
        """(model, split, row_id, actual, predicted, proba) of every row of ``df``."""
        actual = F.col(self.label).cast("int").alias("actual")
        if self.name in BOOSTED:
            rows = df.select(F.lit(0).alias("problem"), F.col(self.key).alias("row_id"), actual,
                             F.array(*[F.col(c).cast("double") for c in self.cols]).alias("x"))
            out = self.model.predict(rows, ["row_id", "actual"])
        elif self.name == "random_forest":
            rows = df.select(F.lit(0).alias("forest"), F.col(self.key).alias("row_id"), actual,
                             F.array(*[F.col(c).cast("double") for c in self.cols]).alias("x"))
            out = self.model.predict(rows, ["row_id", "actual"])
        elif self.name == "knn":
            p = self.params or {}
            found = K.knn_classify(self.model, df.select(*[F.col(c).alias(c) for c in df.columns]), self.key, self.cols, self.label,
                                   k=p.get("n_neighbors", 5), weights=p.get("weights", "distance"),
                                   metric=p.get("metric", "euclidean"), n_classes=self.n_classes)
            out = found.join(df.select(F.col(self.key).alias("row_id"), actual), "row_id")
        elif self.name == "svm":
            out = self.model.predict(df.select(F.col(self.key).alias("row_id"), actual, SV.columns(self.cols).alias("x")), ["row_id", "actual"])
        else:
            scored = self.model.transform(assemble(df, self.cols))
            out = scored.select(F.col(self.key).alias("row_id"), actual, F.col("prediction").cast("int").alias("predicted"),
                                vector_to_array("probability").alias("proba"))
        return out.select(F.lit(self.name).alias("model"), F.lit(split).alias("split"), "row_id", "actual", "predicted", "proba")


def svm_blocks(train: DataFrame, cols: list[str], label: str, width: int, fits: int = 1):
    """(kept blocks of the training rows with balanced weights, their rows) for fits on ``width`` mapped columns.

    Rows stay unmapped, so the mapped width only says how many of the fit's cores have work in a step."""
    n, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    parts = max(frame_parts(n, len(cols), fits, cores), min(-(-n * width // CELLS_PER_TASK), -(-cores // fits)))
    return SV.blocks(SV.rows_of(with_balanced_weight(train, label), cols, label).repartition(parts)), n


def svm_fit(kept, n: int, mapped: SV.Columns, n_classes: int, params: dict | None = None) -> SV.Machine:
    p = params or {}
    # on the hinge loss steps beyond some tens hardly change the margins
    return SV.fit(kept, mapped, n_classes, 1.0 / (p.get("C", 10.0) * n), p.get("max_iter", 50), p.get("tol", 1e-3))


def fit_model(name: str, train: DataFrame, cols: list[str], label: str, key: str, val: DataFrame | None = None,
              params: dict | None = None, n_classes: int | None = None, fits: int = 1) -> Fitted:
    """Fit one model on ``train``. ``val`` gives boosted models their validation curve and, leaf-wise, its early stop;
    ``fits`` says how many optimizers the caller runs side by side."""
    n_classes = n_classes or int(train.agg(F.max(F.col(label).cast("int"))).first()[0]) + 1
    if name == "knn":
        return Fitted(name, train, cols, label, key, params=params, n_classes=n_classes)
    if name in BOOSTED:
        rows = BO.problem_rows(train, cols, label, key, F.lit(BO.TRAIN))
        if val is not None:
            rows = rows.unionByName(BO.problem_rows(val, cols, label, key, F.lit(BO.VAL)))
        t0 = time.time()
        booster = BO.fit(rows, {0: boost_params(name, params)}, n_classes)
        return Fitted(name, booster, cols, label, key, seconds=time.time() - t0, params=params, n_classes=n_classes)
    if name == "random_forest":
        t0 = time.time()
        model = FO.fit(FO.problem_rows(train, cols, label, key), {0: (0, forest_params(params))}, n_classes)
        return Fitted(name, model, cols, label, key, seconds=time.time() - t0, params=params, n_classes=n_classes)
    if name == "svm":
        mapped = SV.feature_map(len(cols), params)
        kept, n = svm_blocks(train, cols, label, mapped.width, fits)
        t0 = time.time()
        model = svm_fit(kept, n, mapped, n_classes, params)
        kept.unpersist()
        return Fitted(name, model, cols, label, key, seconds=time.time() - t0, params=params, n_classes=n_classes)
    tr = with_balanced_weight(assemble(train, cols).withColumn("label_d", F.col(label).cast("double")), label)
    tr = fit_frame(tr.select(label, "label_d", "w", "features"), len(cols), fits)
    spec = build(name, len(cols), float(tr.count()), params, n_classes)
    t0 = time.time()
    model = spec.estimator.fit(tr)
    return Fitted(name, model, cols, label, key, spec, time.time() - t0, params, n_classes)


def fit_score(name: str, train: DataFrame, test: DataFrame, cols: list[str], label: str, key: str,
              val: DataFrame | None = None, params: dict | None = None):
    """Fit on train, predict test and train → (prediction table, fitted model, train seconds)."""
    fitted = fit_model(name, train, cols, label, key, val, params)
    pred = fitted.predict(test, "test").unionByName(fitted.predict(train, "train"))
    return pred, fitted, fitted.seconds


def train_record(pred: DataFrame, seconds: float | None = None) -> DataFrame:
    """(model, split, n, accuracy, log_loss, train_seconds) of a prediction table, both scores in one aggregate."""
    p = F.least(F.greatest(F.element_at("proba", F.col("actual") + 1), F.lit(EPS)), F.lit(1 - EPS))
    return pred.groupBy("model", "split").agg(
        F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("accuracy"),
        (-F.avg(F.ln(p))).alias("log_loss")).withColumn("train_seconds", F.lit(seconds).cast("double"))


def model_facts(pred: DataFrame) -> DataFrame:
    """What must hold of any classifier's table, over all its rows: (split, label, n, proba_sums, argmax, beats_majority).

    Probabilities sum to one, the prediction is the first largest, and on the rows it learned from the model is right
    at least as often as the most frequent label would be. Nothing of that kind holds of unseen rows, so for other
    splits ``beats_majority`` is null.
    """
    top = F.array_position("proba", F.array_max("proba")) - 1
    total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
    rows = pred.groupBy("split", F.col("actual").alias("label")).agg(
        F.count("*").alias("n"), F.max(F.abs(total - 1)).alias("off"), F.count_if(top == F.col("predicted")).alias("same"),
        F.count_if(F.col("predicted") == F.col("actual")).alias("right"))
    split = rows.groupBy("split").agg((F.sum("right") >= F.max("n")).alias("b"))
    return rows.join(split, "split").select(
        "split", "label", "n", (F.col("off") < 1e-9).alias("proba_sums"), (F.col("same") == F.col("n")).alias("argmax"),
        F.when(F.col("split") == "train", F.col("b")).alias("beats_majority"))


def logistic_gradient(fitted: Fitted, train: DataFrame) -> np.ndarray:
    """Gradient of the logistic objective at the returned coefficients (classes x features, 0 at the optimum).

    Summed per Arrow batch, so the driver adds a few small matrices per task.
    """
    k, d = fitted.n_classes, len(fitted.cols)
    weighted = with_balanced_weight(train.withColumn("_row", F.col(fitted.key)), fitted.label)
    both = fitted.predict(train, "train").select("row_id", "actual", "proba").join(
        weighted.select(F.col("_row").alias("row_id"), "w", F.array(*fitted.cols).alias("x")), "row_id")

    def run(frames):
        for pdf in frames:
            if len(pdf):
                x, p, w = np.stack(pdf["x"]), np.stack(pdf["proba"]), pdf["w"].to_numpy()
                p[np.arange(len(p)), pdf["actual"]] -= 1.0
                yield pd.DataFrame({"g": [((p * w[:, None]).T @ x).ravel()], "w": [w.sum()]})

    parts = both.mapInPandas(run, "g array<double>, w double").collect()
    total = sum(r.w for r in parts)
    grad = np.sum([r.g for r in parts], axis=0).reshape(k, d) / total
    return grad + fitted.spec.estimator.getRegParam() * fitted.model.coefficientMatrix.toArray()


def svm_c_sweep(train: DataFrame, val: DataFrame, cols: list[str], label: str, key: str, c_values: list[float],
                params: dict | None = None) -> DataFrame:
    """(kernel, C, split, n, accuracy) on train and val for each C; all fits share the kept rows."""
    p = dict(params or {})
    n_classes = int(train.agg(F.max(F.col(label).cast("int"))).first()[0]) + 1
    mapped = SV.feature_map(len(cols), p)
    kept, n = svm_blocks(train, cols, label, mapped.width)

    def fit(c):
        return Fitted("svm", svm_fit(kept, n, mapped, n_classes, {**p, "C": c}), cols, label, key, n_classes=n_classes)

    fits = in_threads(train.sparkSession, fit, c_values, len(c_values))
    kept.unpersist()
    out = None
    for c, fitted in zip(c_values, fits):
        for split, df in (("train", train), ("val", val)):
            row = fitted.predict(df, split).agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("accuracy"))
            row = row.select(F.lit(p.get("kernel", "rbf")).alias("kernel"), F.lit(float(c)).alias("C"), F.lit(split).alias("split"), "n", "accuracy")
            out = row if out is None else out.unionByName(row)
    return out


def importances(fitted: Fitted, cols: list[str], spark) -> DataFrame:
    """(model, feature, importance); KNN and the SVM have none."""
    name, model = fitted.name, fitted.model
    if name == "logistic":
        imp = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)  # k x d, bounded by classes x features
    elif name == "random_forest":
        imp = model.importances(spark)
    elif name in BOOSTED:
        imp = model.importances(0, "gain" if name == "boosted" else "split")
    else:
        return spark.createDataFrame([], "model string, feature string, importance double")
    return spark.createDataFrame([(name, c, float(v)) for c, v in zip(cols, imp)],
                                 "model string, feature string, importance double")


def loss_curve(fitted: Fitted, spark) -> DataFrame:
    """(model, curve_type, x, series, value); models without a curve by iteration give no row."""
    rows = []
    if fitted.name == "logistic":
        rows = [("logistic", "objective", i, "train", float(v)) for i, v in enumerate(fitted.model.summary.objectiveHistory)]
    elif fitted.name in BOOSTED:
        rows = [(fitted.name, "log_loss", r, split, loss) for _, r, split, loss, _ in fitted.model.curve]
    return spark.createDataFrame(rows, "model string, curve_type string, x int, series string, value double")


def pca_2d(df: DataFrame, cols: list[str], key: str, label: str) -> DataFrame:
    """V6: 2-D PCA of centred data; each component's sign makes its largest |loading|
    positive. → (row_id, label, pc1, pc2, explained_1, explained_2)."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols])  # one row
    cen = df.crossJoin(F.broadcast(means.select(*[F.col(c).alias(f"_m_{c}") for c in cols]))).select(
        key, label, *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in cols])
    v = assemble(cen, cols)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(v)
    pcs = model.pc.toArray()  # d x 2 (small)
    signs = [1.0 if pcs[np.argmax(np.abs(pcs[:, j])), j] >= 0 else -1.0 for j in range(2)]
    ev = model.explainedVariance.toArray()
    arr = vector_to_array("pc")
    return model.transform(v).select(F.col(key).alias("row_id"), F.col(label).alias("label"),
                                     (arr[0] * signs[0]).alias("pc1"), (arr[1] * signs[1]).alias("pc2"),
                                     F.lit(float(ev[0])).alias("explained_1"), F.lit(float(ev[1])).alias("explained_2"))


def pca_facts(projected: DataFrame, df: DataFrame, cols: list[str], key: str, label: str) -> dict[str, bool]:
    """Of a ``pca_2d`` table: centred, uncorrelated, variances in the explained shares and order, and no direction of the
    centred rows (any column, as a spot check) holds more variance than the first component."""
    a = projected.agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.var_samp("pc1").alias("v1"), F.var_samp("pc2").alias("v2"),
                      F.covar_samp("pc1", "pc2").alias("c"), F.max("explained_1").alias("e1"), F.max("explained_2").alias("e2")).first()
    v = df.agg(*[F.var_samp(c).alias(c) for c in cols]).first()
    total = sum(v)
    return {"centred": abs(a.m1) < 1e-9 and abs(a.m2) < 1e-9, "uncorrelated": abs(a.c) < 1e-9 * max(1.0, a.v1),
            "shares": abs(a.v1 / total - a.e1) < 1e-9 and abs(a.v2 / total - a.e2) < 1e-9, "ordered": a.v1 >= a.v2,
            "largest": a.v1 >= max(v) - 1e-9}


def forest_nodes(fitted: Fitted, spark) -> DataFrame:
    """Nodes of a fitted forest as a table: (tree, node, feature, threshold, left, right, votes); feature -1 marks a leaf,
    votes sum to one."""
    return fitted.model.nodes(spark)


def tree_prefix_curve(fitted: Fitted, test: DataFrame, sizes: list[int]) -> DataFrame:
    """(n_trees, accuracy) of the first n trees of ONE fitted forest for each n in ``sizes``, in one pass.

    A task adds up the votes tree by tree and is scored whenever a size is reached. Sizes beyond the forest are left out.
    """
    rows = test.select(F.col(fitted.label).cast("int").alias("y"), F.array(*[F.col(c).cast("double") for c in fitted.cols]).alias("x"))
    return fitted.model.prefix_hits(rows, sorted(set(sizes))).groupBy("n_trees").agg((F.sum("right") / F.sum("n")).alias("accuracy"))
