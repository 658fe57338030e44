"""Presets and fixed values.

FIXED VALUES — these must equal the original pipeline's values for results
to match; they are stated plainly and in their natural order.
"""

from __future__ import annotations

# ---- fixed values -----------------------------------------------------------
# Seven canonical classes of the shape-measurement dataset.
BEAN_CLASSES = ["BARBUNYA", "BOMBAY", "CALI", "DERMASON", "HOROZ", "SEKER", "SIRA"]
# Sixteen numeric features, in file order.
BEAN_FEATURES = [
    "Area", "Perimeter", "MajorAxisLength", "MinorAxisLength",
    "AspectRation", "Eccentricity", "ConvexArea", "EquivDiameter",
    "Extent", "Solidity", "roundness", "Compactness",
    "ShapeFactor1", "ShapeFactor2", "ShapeFactor3", "ShapeFactor4",
]
TARGET = "Class"
# Ratio features: (name, numerator, denominator, kind); kind 'ratio' is
# a / (b + 1e-8), kind 'normdiff' is (a - b) / (a + b + 1e-8).
BEAN_RATIOS = [
    ("AreaToPerimeter", "Area", "Perimeter", "ratio"),
    ("ConvexityRatio", "Area", "ConvexArea", "ratio"),
    ("MajorToMinor", "MajorAxisLength", "MinorAxisLength", "ratio"),
    ("Elongation", "MajorAxisLength", "MinorAxisLength", "normdiff"),
    ("FormFactor", "EquivDiameter", "MajorAxisLength", "ratio"),
    ("AreaToMajorAxis", "Area", "MajorAxisLength", "ratio"),
]
RATIO_EPS = 1e-8
INTERACTION_TOP_N = 8
K_BEST = 30
TOP_LOG = 10
SUFFIX = " cm"
SUFFIX_PROBE = "cm"
IQR_FACTOR = 1.5
KNN_IMPUTE_K = 5
# Noise configurations: (type, percent), in this order.
NOISE_CONFIGS = [
    ("gaussian", 1.0), ("gaussian", 5.0), ("gaussian", 10.0), ("gaussian", 15.0), ("gaussian", 20.0),
    ("salt_pepper", 1.0), ("salt_pepper", 5.0), ("salt_pepper", 10.0),
    ("label", 5.0), ("label", 10.0), ("label", 15.0), ("label", 20.0),
    ("outlier", 1.0), ("outlier", 5.0),
]
OUTLIER_MAGNITUDE = 5.0
# Overfitting levels: gap < 0.02 Low, < 0.05 Moderate, < 0.10 High, else Severe.
OVERFIT_THRESHOLDS = [(0.02, "Low"), (0.05, "Moderate"), (0.10, "High")]
OVERFIT_TOP = "Severe"
# KNN accuracy-versus-k sweep.
KNN_K_VALUES = [1, 3, 5, 7, 9, 11, 15, 20]
# Forest size curve.
RF_SIZES = [10, 20, 50, 100, 150, 200, 300, 500]
# Learning-curve train fractions.
TRAIN_SIZES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
# SVM C sweep.
SVM_C_VALUES = [0.01, 0.1, 1.0, 10.0, 100.0]
CV_FOLDS = 5
# Search spaces: model -> (method, values in their order, draws of a random search).
PARAM_GRIDS = {
    "logistic": ("grid", {"C": [0.01, 0.1, 1, 10, 100], "solver": ["lbfgs", "saga"], "max_iter": [1000, 3000, 5000]}, 0),
    "knn": ("grid", {"n_neighbors": [3, 5, 7, 9, 11, 15], "weights": ["uniform", "distance"],
                     "metric": ["euclidean", "manhattan", "minkowski"], "p": [1, 2]}, 0),
    "svm": ("grid", {"C": [0.1, 1, 10, 100], "kernel": ["rbf", "poly", "linear"], "gamma": ["scale", "auto", 0.01, 0.1]}, 0),
    "random_forest": ("random", {"n_estimators": [100, 200, 500], "max_depth": [10, 20, 30, None],
                                 "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                                 "class_weight": ["balanced", "balanced_subsample", None]}, 6),
    "boosted": ("random", {"n_estimators": [100, 200, 500], "max_depth": [3, 6, 9], "learning_rate": [0.01, 0.05, 0.1, 0.3],
                           "subsample": [0.7, 0.8, 1.0], "colsample_bytree": [0.7, 0.8, 1.0], "gamma": [0, 0.1, 0.3],
                           "reg_alpha": [0, 0.1, 1.0], "reg_lambda": [1, 1.5, 2.0]}, 8),
    "boosted_leafwise": ("random", {"n_estimators": [100, 200, 300, 500], "num_leaves": [31, 63, 127],
                                    "learning_rate": [0.01, 0.05, 0.1], "min_child_samples": [20, 50, 100],
                                    "subsample": [0.7, 0.8, 1.0], "colsample_bytree": [0.7, 0.8, 1.0],
                                    "reg_alpha": [0, 0.1, 1.0], "reg_lambda": [0, 0.1, 1.0], "class_weight": ["balanced"]}, 9),
}
SEED = 42
VAL_FRACTION = 0.1
TEST_FRACTION = 0.2
# Chart constants.
HIST_BINS = 40
KDE_GRID = 200
BOX_TOP_N = 8
IMPORTANCE_TOP = 20
IMPORTANCE_TOP_PER_MODEL = 15
CURVE_TAIL = 50
CURVE_TAIL_WHEN = 100
MISSING_MAP_ROWS = 200
CONFUSION_LABEL_MIN = 0.05
# ---- end of fixed values -------------------------------------------------


def variant_map(canonical: list[str]) -> list[tuple[str, str]]:
    """Dirty spellings -> canonical, generated by rule.

    Three families: trailing blank, lower case, and for labels containing E or O
    the digit-for-letter spelling (E->3, O->0). For BEAN_CLASSES this yields the
    18-entry map of the original pipeline (7 + 7 + 4).
    """
    out = [(c + " ", c) for c in canonical]
    out += [(c.lower(), c) for c in canonical]
    for c in canonical:
        leet = c.replace("E", "3").replace("O", "0")
        if leet != c:
            out.append((leet, c))
    return out


def overfit_level_sql(gap: str) -> str:
    parts = " ".join(f"WHEN {gap} < {t} THEN '{name}'" for t, name in OVERFIT_THRESHOLDS)
    return f"CASE {parts} ELSE '{OVERFIT_TOP}' END"
