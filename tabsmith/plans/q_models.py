"""Queries for encoding, scaling, splitting, noise, KNN and MLlib models (P, N, M, T, A8-A9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabsmith.session import ensure_checkpoint_dir, hold, in_threads
from tabsmith.functions.keyed import keyed_uniform, normal_sql, u_sql
from tabsmith.operators import noise as N
from tabsmith.operators import scale as S
from tabsmith.operators import split as SP
from tabsmith.operators.impute import impute_median
from tabsmith.plans import oracle_fixtures as OF
from tabsmith.plans.registry import query
from tabsmith.sources import fixtures as FX
from tabsmith.sources.io import persist_table, read_table

OFS = FX.ORDER_FEATURES
LS = FX.LINE_FEATURES
OFW = OF.with_(OF.ORDER_FEATURES)
LSW = OF.with_(OF.LINE_STATS)


def _orders_class(spark, sf):
    return read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"),
                                                  F.col("o_orderpriority").alias("class"))


_ENC_SQL = """WITH m AS (SELECT o_orderpriority AS class, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS label_idx
           FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT o_orderkey AS row_id, o_orderpriority AS class, m.label_idx FROM orders LEFT JOIN m ON o_orderpriority = m.class"""


@query("label_encode", _ENC_SQL)
def label_encode(spark, sf):
    """Sorted distinct labels → 0..k-1."""
    return S.encode_labels(_orders_class(spark, sf), "class").select("row_id", "class", "label_idx")


@query("label_decode", f"SELECT row_id, label_idx, class AS label FROM ({_ENC_SQL})")
def label_decode(spark, sf):
    """Index → label through the fitted mapping."""
    df = _orders_class(spark, sf)
    m = S.label_index(df, "class")
    enc = S.encode_labels(df, "class", mapping=m).select("row_id", "label_idx")
    return S.decode_labels(enc, "label_idx", m, "class", out="label").select("row_id", "label_idx", "label")


@query("class_weights", """
SELECT class, n, sum(n) OVER () / (count(*) OVER () * n) AS weight
FROM (SELECT o_orderpriority AS class, count(*)::BIGINT AS n FROM orders GROUP BY 1)""", doubles=("weight",))
def class_weights(spark, sf):
    """Balanced weights."""
    return S.class_weights(_orders_class(spark, sf), "class")


def _scale_sql(center: str, scale: str, table: str = "line_stats", by_split: bool = False) -> str:
    stats = ", ".join(f"{center.format(c=c)} AS c_{c}, {scale.format(c=c)} AS s_{c}" for c in LS)
    sel = ", ".join(f"({c} - c_{c}) / (CASE WHEN s_{c} < {S.EPS10!r} THEN 1.0 ELSE s_{c} END) AS {c}" for c in LS)
    return LSW + f", st AS (SELECT {stats} FROM {table})\nSELECT class, {sel} FROM {table}, st"


@query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"), doubles=tuple(LS), digits=8)
def scale_standard(spark, sf):
    """(x - mean) / std_pop."""
    return S.scale(FX.line_stats(spark, sf), LS, "standard")


@query("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})"), doubles=tuple(LS))
def scale_minmax(spark, sf):
    """(x - min) / (max - min)."""
    return S.scale(FX.line_stats(spark, sf), LS, "minmax")


@query("scale_robust", _scale_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
       doubles=tuple(LS))
def scale_robust(spark, sf):
    """P5: (x - median) / IQR."""
    return S.scale(FX.line_stats(spark, sf), LS, "robust")


@query("scale_none", LSW + "SELECT class, " + ", ".join(LS) + " FROM line_stats")
def scale_none(spark, sf):
    """Identity."""
    return S.scale(FX.line_stats(spark, sf), LS, "none")


_SPLIT3 = (f"CASE WHEN {u_sql('row_id', repr('split3'))} < 0.72 THEN 'train' "
           f"WHEN {u_sql('row_id', repr('split3'))} < 0.9 THEN 'test' ELSE 'val' END")


def _split3(key):
    u = keyed_uniform(key, "split3")
    return F.when(u < 0.72, "train").when(u < 0.9, "test").otherwise("val")


def _apply_sql(inverse: bool) -> str:
    stats = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in OFS)
    sc = "(CASE WHEN s_{c} < " + repr(S.EPS10) + " THEN 1.0 ELSE s_{c} END)"
    if inverse:
        sel = ", ".join(f"((({c} - c_{c}) / {sc.format(c=c)}) * {sc.format(c=c)} + c_{c}) AS {c}" for c in OFS)
    else:
        sel = ", ".join(f"({c} - c_{c}) / {sc.format(c=c)} AS {c}" for c in OFS)
    return OFW + f""", sp AS (SELECT *, {_SPLIT3} AS split FROM order_features),
st AS (SELECT {stats} FROM sp WHERE split = 'train')
SELECT row_id, split, {sel} FROM sp, st"""


def _fit_train_scaler(spark, sf):
    of = FX.order_features(spark, sf).withColumn("split", _split3("row_id"))
    sc = S.Scaler("standard", OFS, []).fit(of.where(F.col("split") == "train"))
    return of, sc


@query("scale_apply", _apply_sql(False), doubles=tuple(OFS), digits=8)
def scale_apply(spark, sf):
    """Statistics fitted on the train split, applied to every split."""
    of, sc = _fit_train_scaler(spark, sf)
    return sc.transform(of).select("row_id", "split", *OFS)


@query("scale_inverse", _apply_sql(True), doubles=tuple(OFS))
def scale_inverse(spark, sf):
    """Transform then inverse_transform (round trip)."""
    of, sc = _fit_train_scaler(spark, sf)
    return sc.inverse_transform(sc.transform(of)).select("row_id", "split", *OFS)


def _rank_sql(tag: str) -> str:
    return (f"SELECT o_orderkey AS row_id, o_orderpriority AS class, count(*) OVER (PARTITION BY o_orderpriority) AS cn, "
            f"row_number() OVER (PARTITION BY o_orderpriority ORDER BY {u_sql('o_orderkey', repr(tag))}, o_orderkey) - 1 AS rk "
            f"FROM orders")


@query("stratified_split", f"""
SELECT row_id, class, CASE WHEN rk < round(cn * 0.1) THEN 'val'
                           WHEN rk < round(cn * 0.1) + round((cn - round(cn * 0.1)) * 0.2) THEN 'test'
                           ELSE 'train' END AS split
FROM ({_rank_sql('split')})""")
def stratified_split(spark, sf):
    """Stratified 10 % val, then 20 % of the rest test."""
    return SP.stratified_split(_orders_class(spark, sf), "class", "row_id").select("row_id", "class", "split")


@query("stratified_folds", f"SELECT row_id, class, (rk % 5)::INTEGER AS fold FROM ({_rank_sql('fold')})")
def stratified_folds(spark, sf):
    """P10: 5 stratified folds."""
    return SP.stratified_folds(_orders_class(spark, sf), "class", "row_id").select("row_id", "class", "fold")


# ---------------------------------------------------------------- N: noise

def _tag_sql(nid, c, what):
    return f"'{what}|{nid}|{c}'"


def _noise_sql(kind: str, ratio: float, nid: int) -> str:
    stats = ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}"
                      for c in OFS)
    sel = []
    for c in OFS:
        if kind == "gaussian":
            sel.append(f"{c} + {ratio!r} * std_{c} * {normal_sql('row_id', _tag_sql(nid, c, 'g'))} AS {c}")
        elif kind == "salt_pepper":
            sel.append(f"CASE WHEN {u_sql('row_id', _tag_sql(nid, c, 'sp'))} < {ratio!r} THEN "
                       f"(CASE WHEN {u_sql('row_id', _tag_sql(nid, c, 'spv'))} < 0.5 THEN min_{c} ELSE max_{c} END) "
                       f"ELSE {c} END AS {c}")
        else:
            sel.append(f"CASE WHEN {u_sql('row_id', _tag_sql(nid, c, 'o'))} < {ratio!r} THEN mean_{c} + "
                       f"(CASE WHEN {u_sql('row_id', _tag_sql(nid, c, 'os'))} < 0.5 THEN 1.0 ELSE -1.0 END) * 5.0 * std_{c} "
                       f"ELSE {c} END AS {c}")
    return OFW + f", st AS (SELECT {stats} FROM order_features)\nSELECT row_id, class, {', '.join(sel)} FROM order_features, st"


@query("noise_gaussian", _noise_sql("gaussian", 0.05, 2), doubles=tuple(OFS))
def noise_gaussian(spark, sf):
    """5 % Gaussian noise."""
    return N.add_gaussian(FX.order_features(spark, sf), OFS, "row_id", 0.05, noise_id=2)


@query("noise_salt_pepper", _noise_sql("salt_pepper", 0.05, 7), doubles=tuple(OFS))
def noise_salt_pepper(spark, sf):
    """5 % salt-and-pepper cells."""
    return N.add_salt_pepper(FX.order_features(spark, sf), OFS, "row_id", 0.05, noise_id=7)


@query("noise_outlier", _noise_sql("outlier", 0.05, 14), doubles=tuple(OFS))
def noise_outlier(spark, sf):
    """5 % outlier cells at mean ± 5 std."""
    return N.add_outliers(FX.order_features(spark, sf), OFS, "row_id", 0.05, noise_id=14)


@query("noise_label", f"""WITH base AS (SELECT o_orderkey AS row_id, (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) AS label
  FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY {u_sql('row_id', "'flip|10'")}, row_id) - 1 AS rk, count(*) OVER () AS n FROM base)
SELECT row_id, CASE WHEN rk < floor(n * 0.1) THEN
  ((label + 1 + CAST(floor({u_sql('row_id', "'to|10'")} * 4) AS INTEGER)) % 5) ELSE label END::INTEGER AS label FROM r""")
def noise_label(spark, sf):
    """Exactly int(n · 10 %) labels flipped to another class."""
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("label"))
    return N.add_label_noise(o, "label", "row_id", 0.10, 5, noise_id=10).select("row_id", "label")


def _configs_sql() -> str:
    from tabsmith.functions.presets import NOISE_CONFIGS
    rows = []
    for i, (t, p) in enumerate(NOISE_CONFIGS):
        name = {"gaussian": "gaussian sigma", "salt_pepper": "salt-pepper", "label": "label flip",
                "outlier": "outlier"}[t]
        rows.append(f"({i + 1}, '{t}', {float(p)!r}, {p / 100.0!r}, '{name} {int(p)}%', "
                    f"'{'label' if t == 'label' else 'feature'}')")
    return f"""WITH c AS (SELECT * FROM (VALUES {', '.join(rows)}) t(noise_id, type, param, ratio, label, category)),
n AS (SELECT count(*) AS n_rows FROM order_features)
SELECT noise_id::INTEGER AS noise_id, type, param::DOUBLE AS param, ratio::DOUBLE AS ratio, label, category,
       n_rows::BIGINT AS n_rows,
       (CASE WHEN type = 'label' THEN floor(n_rows * ratio) WHEN type = 'gaussian' THEN n_rows * {len(OFS)}
             ELSE floor(n_rows * {len(OFS)} * ratio) END)::BIGINT AS n_affected
FROM c, n"""


@query("noise_configs", OFW.rstrip() + ", " + _configs_sql()[len("WITH "):])
def noise_configs(spark, sf):
    """The 14 configurations with the planned size on the order fixture."""
    n = FX.order_features(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))
    c = N.noise_configs(spark).crossJoin(n)
    d = len(OFS)
    aff = (F.when(F.col("type") == "label", F.floor(F.col("n_rows") * F.col("ratio")))
           .when(F.col("type") == "gaussian", F.col("n_rows") * d)
           .otherwise(F.floor(F.col("n_rows") * d * F.col("ratio"))))
    return c.select("noise_id", "type", "param", "ratio", "label", "category",
                    F.col("n_rows").cast("long").alias("n_rows"), aff.cast("long").alias("n_affected"))


# ---------------------------------------------------------------- M2 / T2 / T3 / A8-A9: KNN on vectors
from pyspark import StorageLevel  # noqa: E402

from tabsmith.functions.presets import KNN_K_VALUES, NOISE_CONFIGS, TRAIN_SIZES  # noqa: E402
from tabsmith.operators import knn as K  # noqa: E402
from tabsmith.operators import modeling as MD  # noqa: E402

VEC = FX.VECTOR_FEATURES
VW = OF.with_(OF.VECTORS)


def _vec_rank_sql(tag: str, table: str = "vectors", part: str = "label") -> str:
    return (f"SELECT *, count(*) OVER (PARTITION BY {part}) AS cn, row_number() OVER (PARTITION BY {part} "
            f"ORDER BY {u_sql('row_id', repr(tag))}, row_id) - 1 AS rk FROM {table}")


VEC_SPLIT_SQL = VW.rstrip() + f""",
vsplit AS (SELECT * EXCLUDE (cn, rk), CASE WHEN rk < round(cn * 0.1) THEN 'val'
           WHEN rk < round(cn * 0.1) + round((cn - round(cn * 0.1)) * 0.2) THEN 'test' ELSE 'train' END AS split
           FROM ({_vec_rank_sql('split')})),
tr AS (SELECT * FROM vsplit WHERE split = 'train'),
te AS (SELECT * FROM vsplit WHERE split = 'test'),
va AS (SELECT * FROM vsplit WHERE split = 'val')"""


def _dist_sql(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in VEC) + ")"


def _vote_sql(pairs: str, grp: list[str], k_expr: str = "5") -> str:
    """Distance-weighted vote over the k nearest (ties by donor id) → (grp..., qid, predicted, proba...)."""
    g = ", ".join(grp + ["qid"])
    gp = ", ".join(grp)
    sep = ", " if grp else ""
    return f"""nb AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY dist, did) AS rn FROM {pairs}),
sel AS (SELECT * FROM nb WHERE rn <= {k_expr}),
hz AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {g}) AS has_zero FROM sel),
votes AS (SELECT {g}, nlabel, sum(CASE WHEN has_zero = 1 THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END)
                                     ELSE 1.0 / dist END) AS score FROM hz GROUP BY {g}, nlabel),
ranked AS (SELECT *, score / sum(score) OVER (PARTITION BY {g}) AS p,
                  row_number() OVER (PARTITION BY {g} ORDER BY score DESC, nlabel) AS r FROM votes),
pred AS (SELECT {g}, max(CASE WHEN r = 1 THEN nlabel END)::INTEGER AS predicted FROM ranked GROUP BY {g})"""


def vector_splits(spark, sf):
    v = FX.vectors(spark, sf)
    return hold(SP.stratified_split(v, "label", "row_id"))


@query("knn_predict", VEC_SPLIT_SQL + f""",
pairs AS (SELECT te.row_id AS qid, tr.row_id AS did, tr.label AS nlabel, {_dist_sql('te', 'tr')} AS dist FROM te, tr),
{_vote_sql('pairs', [])},
cls AS (SELECT range AS c FROM range(0, (SELECT max(label) + 1 FROM tr))),
probs AS (SELECT p.qid, list(coalesce(r.p, 0.0) ORDER BY cls.c) AS proba
          FROM pred p CROSS JOIN cls LEFT JOIN ranked r ON r.qid = p.qid AND r.nlabel = cls.c GROUP BY p.qid)
SELECT te.row_id, te.label AS actual, pred.predicted, probs.proba
FROM te JOIN pred ON te.row_id = pred.qid JOIN probs ON probs.qid = te.row_id""", double_lists=("proba",))
def knn_predict(spark, sf):
    """M2: k=5 distance-weighted KNN, train → test (probabilities per class)."""
    s = vector_splits(spark, sf)
    tr, te = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    p = K.knn_classify(tr, te, "row_id", VEC, "label", k=5)
    return p.join(te.select("row_id", F.col("label").alias("actual")), "row_id").select(
        "row_id", "actual", "predicted", "proba")


_KS = ", ".join(f"({k})" for k in KNN_K_VALUES)


@query("knn_accuracy_by_k", VEC_SPLIT_SQL + f""",
pairs0 AS (SELECT va.row_id AS qid, tr.row_id AS did, tr.label AS nlabel, {_dist_sql('va', 'tr')} AS dist FROM va, tr),
ks AS (SELECT * FROM (VALUES {_KS}) t(k)),
pairs AS (SELECT * FROM pairs0 CROSS JOIN ks),
{_vote_sql('pairs', ['k'], 'k')}
SELECT pred.k::INTEGER AS k, avg(CASE WHEN pred.predicted = va.label THEN 1.0 ELSE 0.0 END) AS accuracy
FROM pred JOIN va ON pred.qid = va.row_id GROUP BY pred.k""", doubles=("accuracy",))
def knn_accuracy_by_k(spark, sf):
    """Validation accuracy for k in {1,3,5,7,9,11,15,20} from one top-20 search."""
    s = vector_splits(spark, sf)
    tr, va = s.where(F.col("split") == "train"), s.where(F.col("split") == "val")
    p = K.knn_classify(tr, va, "row_id", VEC, "label", ks=KNN_K_VALUES)
    j = p.join(va.select("row_id", "label"), "row_id")
    return j.groupBy(F.col("k").cast("int").alias("k")).agg(
        F.avg(F.when(F.col("predicted") == F.col("label"), 1.0).otherwise(0.0)).alias("accuracy"))


TRF_SQL = f""",
trf AS (SELECT * EXCLUDE (cn, rk), (rk % 5)::INTEGER AS fold FROM ({_vec_rank_sql('fold', 'tr')}))"""


@query("knn_cv", VEC_SPLIT_SQL + TRF_SQL + f""",
pairs AS (SELECT q.fold AS f, q.row_id AS qid, d.row_id AS did, d.label AS nlabel, {_dist_sql('q', 'd')} AS dist
          FROM trf q JOIN trf d ON q.fold <> d.fold),
{_vote_sql('pairs', ['f'])},
sc AS (SELECT pred.f AS fold, avg(CASE WHEN pred.predicted = q.label THEN 1.0 ELSE 0.0 END) AS accuracy
       FROM pred JOIN trf q ON pred.qid = q.row_id GROUP BY pred.f)
SELECT fold, accuracy, avg(accuracy) OVER () AS mean, stddev_pop(accuracy) OVER () AS std,
       min(accuracy) OVER () AS min, max(accuracy) OVER () AS max FROM sc""",
       doubles=("accuracy", "mean", "std", "min", "max"))
def knn_cv(spark, sf):
    """5-fold stratified CV accuracy of KNN (k=5) on the train split."""
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    scores = MD.knn_cv_scores(s, "row_id", VEC, "label", k=5, folds=5)
    return MD.cv_summary(scores)


_TS = ", ".join(f"({i}, {f!r})" for i, f in enumerate(TRAIN_SIZES))


@query("knn_learning_curve", VEC_SPLIT_SQL + TRF_SQL + f""",
sizes AS (SELECT si, CAST(frac AS DOUBLE) AS frac FROM (VALUES {_TS}) t(si, frac)),
tpos AS (SELECT f.fold AS cvf, t.*, row_number() OVER (PARTITION BY f.fold ORDER BY {u_sql('t.row_id', "'lc'")}, t.row_id) - 1 AS pos,
                count(*) OVER (PARTITION BY f.fold) AS ntr
         FROM (SELECT DISTINCT fold FROM trf) f JOIN trf t ON t.fold <> f.fold),
pref AS (SELECT s.si, floor(s.frac * tp.ntr)::BIGINT AS n_train, tp.* FROM tpos tp CROSS JOIN sizes s
         WHERE tp.pos < floor(s.frac * tp.ntr)),
vpairs AS (SELECT p.si, p.cvf, q.row_id AS qid, p.row_id AS did, p.label AS nlabel, {_dist_sql('q', 'p')} AS dist
           FROM pref p JOIN trf q ON q.fold = p.cvf),
tpairs AS (SELECT p.si, p.cvf, q.row_id AS qid, p.row_id AS did, p.label AS nlabel, {_dist_sql('q', 'p')} AS dist
           FROM pref p JOIN pref q ON q.si = p.si AND q.cvf = p.cvf),
{_vote_sql('vpairs', ['si', 'cvf'])},
vsc AS (SELECT pred.si, pred.cvf, avg(CASE WHEN pred.predicted = q.label THEN 1.0 ELSE 0.0 END) AS acc
        FROM pred JOIN trf q ON pred.qid = q.row_id GROUP BY pred.si, pred.cvf),
{_vote_sql('tpairs', ['si', 'cvf']).replace('nb AS', 'nb2 AS').replace('FROM nb ', 'FROM nb2 ').replace('sel AS', 'sel2 AS').replace('FROM sel', 'FROM sel2').replace('hz AS', 'hz2 AS').replace('FROM hz ', 'FROM hz2 ').replace('votes AS', 'votes2 AS').replace('FROM votes', 'FROM votes2').replace('ranked AS', 'ranked2 AS').replace('FROM ranked', 'FROM ranked2').replace('pred AS', 'pred2 AS')},
tsc AS (SELECT pred2.si, pred2.cvf, avg(CASE WHEN pred2.predicted = q.label THEN 1.0 ELSE 0.0 END) AS acc
        FROM pred2 JOIN trf q ON pred2.qid = q.row_id GROUP BY pred2.si, pred2.cvf),
ns AS (SELECT si, max(n_train) AS n_train FROM pref GROUP BY si)
SELECT ns.n_train::BIGINT AS train_size, avg(tsc.acc) AS train_mean, stddev_pop(tsc.acc) AS train_std,
       avg(vsc.acc) AS val_mean, stddev_pop(vsc.acc) AS val_std
FROM vsc JOIN tsc ON vsc.si = tsc.si AND vsc.cvf = tsc.cvf JOIN ns ON ns.si = vsc.si GROUP BY ns.si, ns.n_train""",
       doubles=("train_mean", "train_std", "val_mean", "val_std"))
def knn_learning_curve(spark, sf):
    """10 train sizes x 5 folds → mean/std train and validation accuracy (KNN)."""
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    return MD.knn_learning_curve(s, "row_id", VEC, "label", TRAIN_SIZES, k=5, folds=5)


# ---------------------------------------------------------------- A8-A12: KNN robustness
from tabsmith.operators import compare as A  # noqa: E402
from tabsmith.operators import robustness as R  # noqa: E402


def _settings_sql() -> str:
    rows = ["(0, 'clean', 0.0, 0.0, 'clean', 'none')"]
    for i, (t, p) in enumerate(NOISE_CONFIGS):
        name = {"gaussian": "gaussian sigma", "salt_pepper": "salt-pepper", "label": "label flip",
                "outlier": "outlier"}[t]
        rows.append(f"({i + 1}, '{t}', {float(p)!r}, {p / 100.0!r}, '{name} {int(p)}%', "
                    f"'{'label' if t == 'label' else 'feature'}')")
    return (f"cfg AS (SELECT noise_id::INTEGER AS noise_id, type, param::DOUBLE AS param, ratio::DOUBLE AS ratio, "
            f"label AS nlabel_name, category FROM (VALUES {', '.join(rows)}) t(noise_id, type, param, ratio, label, category))")


def _robust_sql() -> str:
    stats = ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}"
                      for c in VEC)

    def tag(what, c=""):
        return f"('{what}|' || CAST(noise_id AS VARCHAR) || '{'|' + c if c else ''}')"

    cols = []
    for c in VEC:
        g = f"{c} + ratio * std_{c} * {normal_sql('row_id', tag('g', c))}"
        sp = (f"CASE WHEN {u_sql('row_id', tag('sp', c))} < ratio THEN (CASE WHEN {u_sql('row_id', tag('spv', c))} "
              f"< 0.5 THEN min_{c} ELSE max_{c} END) ELSE {c} END")
        o = (f"CASE WHEN {u_sql('row_id', tag('o', c))} < ratio THEN mean_{c} + (CASE WHEN "
             f"{u_sql('row_id', tag('os', c))} < 0.5 THEN 1.0 ELSE -1.0 END) * 5.0 * std_{c} ELSE {c} END")
        cols.append(f"CASE WHEN type = 'gaussian' THEN {g} WHEN type = 'salt_pepper' THEN {sp} "
                    f"WHEN type = 'outlier' THEN {o} ELSE {c} END AS {c}")
    return VEC_SPLIT_SQL + f""",
{_settings_sql()},
st AS (SELECT {stats} FROM tr),
ncls AS (SELECT max(label) + 1 AS kc FROM (SELECT label FROM tr UNION ALL SELECT label FROM te)),
ntr AS (SELECT count(*) AS n FROM tr),
rep AS (SELECT noise_id, type, ratio, row_id, label, {', '.join(cols)} FROM tr, cfg, st),
rk AS (SELECT *, row_number() OVER (PARTITION BY noise_id ORDER BY {u_sql('row_id', tag('flip'))}, row_id) - 1 AS frank
       FROM rep),
noisy AS (SELECT rk.* EXCLUDE (label, frank), CASE WHEN type = 'label' AND frank < floor(n * ratio) THEN
            ((label + 1 + CAST(floor({u_sql('row_id', tag('to'))} * (kc - 1)) AS INTEGER)) % kc)::INTEGER ELSE label END AS label
          FROM rk, ntr, ncls),
pairs AS (SELECT d.noise_id, q.row_id AS qid, d.row_id AS did, d.label AS nlabel, {_dist_sql('q', 'd')} AS dist
          FROM te q JOIN noisy d ON true),
{_vote_sql('pairs', ['noise_id'])},
acc AS (SELECT pred.noise_id, avg(CASE WHEN pred.predicted = te.label THEN 1.0 ELSE 0.0 END) AS accuracy
        FROM pred JOIN te ON pred.qid = te.row_id GROUP BY pred.noise_id),
rob AS (SELECT 'knn' AS model, acc.noise_id, cfg.type, cfg.param, cfg.nlabel_name AS label, acc.accuracy
        FROM acc JOIN cfg ON acc.noise_id = cfg.noise_id),
deg AS (SELECT model, noise_id, clean - accuracy AS "drop" FROM (
          SELECT *, max(CASE WHEN noise_id = 0 THEN accuracy END) OVER (PARTITION BY model) AS clean FROM rob)
        WHERE noise_id <> 0 AND accuracy IS NOT NULL)"""


_ROB = _robust_sql()


def _robustness(spark, sf):
    s = vector_splits(spark, sf)
    tr, te = s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")
    return hold(R.knn_robustness(tr, te, VEC, "label", "row_id", k=5))


@query("knn_robustness", _ROB + "\nSELECT * FROM rob", doubles=("accuracy",))
def knn_robustness(spark, sf):
    """KNN trained on clean + 14 noisy copies, scored on the clean test split."""
    return _robustness(spark, sf)


@query("degradation", _ROB + "\nSELECT * FROM deg", doubles=("drop",))
def degradation(spark, sf):
    """A10 (and V19's data)."""
    return A.degradation(_robustness(spark, sf).select("model", "noise_id", "accuracy"))


@query("mean_drop", _ROB + "\nSELECT model, avg(\"drop\") AS mean_drop FROM deg GROUP BY model", doubles=("mean_drop",))
def mean_drop(spark, sf):
    """A11."""
    return A.mean_drop(A.degradation(_robustness(spark, sf).select("model", "noise_id", "accuracy")))


@query("robustness_table", _ROB + """
SELECT rob.model, rob.noise_id, rob.accuracy, deg."drop" FROM rob LEFT JOIN deg
ON rob.model = deg.model AND rob.noise_id = deg.noise_id""", doubles=("accuracy", "drop"))
def robustness_table(spark, sf):
    """A12."""
    return A.robustness_table(_robustness(spark, sf).select("model", "noise_id", "accuracy"))


# ---------------------------------------------------------------- charts over the KNN results
from tabsmith.operators import charts as V  # noqa: E402
from tabsmith.plans.registry import RAW_SQL as _OR  # noqa: E402


def _raw(name: str) -> str:
    """Oracle text of an already registered query (without the rounding wrapper)."""
    return _OR[name]


@query("learning_bands", f"""SELECT train_size, train_mean, train_mean - train_std AS train_lo,
  train_mean + train_std AS train_hi, val_mean, val_mean - val_std AS val_lo, val_mean + val_std AS val_hi
FROM ({_raw('knn_learning_curve')})""", doubles=("train_mean", "train_lo", "train_hi", "val_mean", "val_lo", "val_hi"))
def learning_bands(spark, sf):
    """Learning-curve mean ± std bands (KNN)."""
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    return V.learning_bands(MD.knn_learning_curve(s, "row_id", VEC, "label", TRAIN_SIZES, k=5, folds=5))


@query("cv_box", f"""SELECT 'knn' AS model, quantile_cont(accuracy, 0.0) AS min, quantile_cont(accuracy, 0.25) AS q1,
  quantile_cont(accuracy, 0.5) AS median, quantile_cont(accuracy, 0.75) AS q3, quantile_cont(accuracy, 1.0) AS max
FROM ({_raw('knn_cv')})""", doubles=("min", "q1", "median", "q3", "max"))
def cv_box(spark, sf):
    """CV fold-score box per model."""
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    scores = MD.knn_cv_scores(s, "row_id", VEC, "label", k=5, folds=5).withColumn("model", F.lit("knn"))
    return V.cv_box(scores)


@query("robustness_lines", _ROB + """
SELECT deg.noise_id, cfg.nlabel_name AS label, deg."drop" FROM deg JOIN cfg ON deg.noise_id = cfg.noise_id""",
       doubles=("drop",))
def robustness_lines(spark, sf):
    """Accuracy drop per noise setting, in setting order."""
    rob = _robustness(spark, sf)
    d = A.degradation(rob.select("model", "noise_id", "accuracy"))
    return d.join(rob.select("noise_id", "label"), "noise_id").select("noise_id", "label", "drop")


_NIDS = list(range(1, len(NOISE_CONFIGS) + 1))


@query("robustness_heatmap", _ROB + "\nSELECT model, " + ", ".join(
    f"coalesce(max(CASE WHEN noise_id = {i} THEN accuracy END), 0.0) AS noise_{i}" for i in _NIDS) +
       " FROM rob GROUP BY model", doubles=tuple(f"noise_{i}" for i in _NIDS))
def robustness_heatmap(spark, sf):
    """Model x noise accuracy (clean column excluded)."""
    return V.robustness_heatmap(_robustness(spark, sf), _NIDS)


# ---------------------------------------------------------------- T4 / T6 / V25: KNN grid search (balanced accuracy)
GRID_K = [3, 5, 7, 9, 11, 15]
GRID_METRICS = ("euclidean", "manhattan")
GRID_WEIGHTS = ["uniform", "distance"]


def _manhattan_sql(q: str, d: str) -> str:
    return " + ".join(f"abs({q}.{c} - {d}.{c})" for c in VEC)


def _grid_sql(metrics=GRID_METRICS) -> str:
    dist = {"euclidean": _dist_sql("q", "d"), "manhattan": _manhattan_sql("q", "d")}
    pairs = "\n  UNION ALL ".join(
        f"SELECT '{m}' AS metric, q.fold AS f, q.row_id AS qid, d.row_id AS did, d.label AS nlabel, {dist[m]} AS dist "
        "FROM trf q JOIN trf d ON q.fold <> d.fold" for m in metrics)
    ks = ", ".join(f"({k})" for k in GRID_K)
    ws = ", ".join(f"('{w}')" for w in GRID_WEIGHTS)
    return VEC_SPLIT_SQL + TRF_SQL + f""",
pairs AS ({pairs}),
nb AS (SELECT *, row_number() OVER (PARTITION BY metric, f, qid ORDER BY dist, did) AS rn FROM pairs),
grid AS (SELECT k, w FROM (VALUES {ks}) a(k) CROSS JOIN (VALUES {ws}) b(w)),
sel AS (SELECT nb.*, grid.k, grid.w FROM nb JOIN grid ON nb.rn <= grid.k),
hz AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY metric, f, k, w, qid) AS has_zero FROM sel),
votes AS (SELECT metric, f, k, w, qid, nlabel, sum(CASE WHEN w = 'uniform' THEN 1.0 WHEN has_zero = 1 THEN
                 (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END) AS score FROM hz GROUP BY metric, f, k, w, qid, nlabel),
ranked AS (SELECT *, row_number() OVER (PARTITION BY metric, f, k, w, qid ORDER BY score DESC, nlabel) AS r FROM votes),
pred AS (SELECT metric, f, k, w, qid, max(CASE WHEN r = 1 THEN nlabel END) AS predicted FROM ranked
         GROUP BY metric, f, k, w, qid),
pj AS (SELECT pred.*, q.label AS actual FROM pred JOIN trf q ON pred.qid = q.row_id),
rec AS (SELECT metric, f, k, w, actual, avg(CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END) AS recall
        FROM pj GROUP BY metric, f, k, w, actual),
scores AS (SELECT k::INTEGER AS k, w AS weights, metric, f::INTEGER AS fold, avg(recall) AS score
           FROM rec GROUP BY metric, f, k, w)"""


_GRID = _grid_sql()


def _grid_scores(spark, sf):
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    return hold(MD.knn_grid_scores(s, "row_id", VEC, "label", GRID_K, GRID_WEIGHTS, folds=5, metrics=GRID_METRICS))


@query("grid_search", _GRID + "\nSELECT * FROM scores", doubles=("score",))
def grid_search(spark, sf):
    """T4 (KNN grid, 5-fold balanced accuracy): (k, weights, metric, fold, score)."""
    return _grid_scores(spark, sf)


@query("tuning_best", _GRID + """,
m AS (SELECT k, weights, metric, avg(score) AS mean_score, stddev_pop(score) AS std_score FROM scores GROUP BY k, weights, metric)
SELECT k, weights, metric, mean_score, std_score FROM m ORDER BY round(mean_score, 12) DESC, k, weights, metric LIMIT 1""",
       doubles=("mean_score", "std_score"))
def tuning_best(spark, sf):
    """Best parameters, their mean and std score."""
    return MD.tuning_best(_grid_scores(spark, sf), ["k", "weights", "metric"])


@query("param_sensitivity", _GRID + """
SELECT 'k' AS param, CAST(k AS VARCHAR) AS value, avg(score) AS mean_score FROM scores GROUP BY k
UNION ALL SELECT 'weights', weights, avg(score) FROM scores GROUP BY weights
UNION ALL SELECT 'metric', metric, avg(score) FROM scores GROUP BY metric""", doubles=("mean_score",))
def param_sensitivity(spark, sf):
    """V25 (re-aimed): mean CV score per parameter value."""
    return MD.param_sensitivity(_grid_scores(spark, sf), ["k", "weights", "metric"])


# ---------------------------------------------------------------- M1, M3-M6, A1-A2, T1, T4-T7, V6, V21, V23: models
import time as _time  # noqa: E402

from tabsmith.functions.presets import (IMPORTANCE_TOP_PER_MODEL, K_BEST, PARAM_GRIDS, RF_SIZES, SVM_C_VALUES)  # noqa: E402
from tabsmith.operators import boosting as BO  # noqa: E402
from tabsmith.operators import features as FE  # noqa: E402
from tabsmith.operators import models as ML  # noqa: E402
from tabsmith.operators import tuning as TU  # noqa: E402
from tabsmith.operators.compare import comparison_table  # noqa: E402
from tabsmith.operators.metrics import log_loss  # noqa: E402

LEARN_SPLIT_SQL = "WITH " + OF.LEARNABLE_VECTORS + f""",
vsplit AS (SELECT * EXCLUDE (cn, rk), CASE WHEN rk < round(cn * 0.1) THEN 'val'
           WHEN rk < round(cn * 0.1) + round((cn - round(cn * 0.1)) * 0.2) THEN 'test' ELSE 'train' END AS split
           FROM ({_vec_rank_sql('split', 'learnable')}))"""


_FITTED: dict = {}  # what queries about one model share within a session: prepared rows, fitted models, score tables


def model_data(spark, sf):
    """Vectors with the learnable label, split 72/18/10 (stratified), standardised with train statistics."""
    s = hold(SP.stratified_split(FX.learnable_vectors(spark, sf), "label", "row_id"))
    sc = S.Scaler("standard", VEC, []).fit(s.where(F.col("split") == "train"))
    return ML.fit_frame(sc.transform(s), len(VEC))  # every fit makes many passes over it


def _splits(spark, sf):
    """Train, test and val rows; prepared once and kept below the checkpoint folder, as every model reads them."""
    key = ("data", spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = f"{ensure_checkpoint_dir(spark)}/model-data-{uuid.uuid4().hex}"
        persist_table(model_data(spark, sf), _FITTED[key])
    d = ML.fit_frame(spark.read.parquet(_FITTED[key]), len(VEC))
    return tuple(d.where(F.col("split") == x) for x in ("train", "test", "val"))


def fitted_model(spark, sf, name, params=None, cols=None):
    """The model fitted on the train split; fitted once per session, table folder and parameters."""
    key = (spark.sparkContext.applicationId, sf, name, tuple(sorted((params or {}).items())), tuple(cols or VEC))
    if key not in _FITTED:
        tr, _, va = _splits(spark, sf)
        _FITTED[key] = ML.fit_model(name, tr, cols or VEC, "label", "row_id", val=va, params=params)
    return _FITTED[key]


def _pred(spark, sf, fitted, splits=("test", "train")):
    frames = dict(zip(("train", "test", "val"), _splits(spark, sf)))
    if fitted.name == "knn":  # its model is the training rows
        fitted = ML.fit_model("knn", frames["train"], VEC, "label", "row_id", params=fitted.params)
    out = None
    for split in splits:
        p = fitted.predict(frames[split], split)
        out = p if out is None else out.unionByName(p)
    return hold(out)


def _scored(spark, sf, name, params=None, cols=None):
    fitted = fitted_model(spark, sf, name, params, cols)
    return comparison_table(_pred(spark, sf, fitted)).withColumn("train_seconds", F.lit(float(fitted.seconds)))


FOREST = {"n_estimators": 200, "max_depth": 20}


@query("lr_fit_score")
def lr_fit_score(spark, sf):
    """M1 / A1: multinomial logistic regression (L2, C=1, balanced)."""
    return _scored(spark, sf, "logistic")


@query("rf_fit_score")
def rf_fit_score(spark, sf):
    """M4: random forest (200 trees, depth 20, balanced)."""
    return _scored(spark, sf, "random_forest", FOREST)


def selected_columns(spark, sf):
    """The 30 vector columns with the highest F, as the original's models get 30 selected features."""
    tr, _, _ = _splits(spark, sf)
    top = FE.select_top_k(FE.anova_f(tr, VEC, "label"), K_BEST).collect()  # 30 names
    names = {r.feature for r in top}
    return [c for c in VEC if c in names]


KERNELS = ("rbf", "poly", "linear")


@query("svm_fit_score")
def svm_fit_score(spark, sf):
    """M3: the SVM (C=10, balanced) with each kernel, on the 30 selected columns."""
    cols = selected_columns(spark, sf)
    out = None
    for kernel in KERNELS:
        row = _scored(spark, sf, "svm", {"kernel": kernel}, cols).withColumn("kernel", F.lit(kernel))
        out = row if out is None else out.unionByName(row)
    return out


def _sweep(spark, sf):
    key = ("sweep", spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        tr, _, va = _splits(spark, sf)
        cols = selected_columns(spark, sf)
        _FITTED[key] = [tuple(r) for kernel in KERNELS for r in ML.svm_c_sweep(
            tr, va, cols, "label", "row_id", SVM_C_VALUES, {"kernel": kernel}).collect()]  # 10 rows a kernel
    return spark.createDataFrame(_FITTED[key], "kernel string, C double, split string, n long, accuracy double")


@query("svm_c_sweep")
def svm_c_sweep(spark, sf):
    """Train and val accuracy for five values of C, each kernel."""
    return _sweep(spark, sf)


_CS = ", ".join(f"({c!r}::DOUBLE)" for c in SVM_C_VALUES)


@query("svm_c_facts", LEARN_SPLIT_SQL + f"""
SELECT kernel, C, split, count(*) AS n, true AS scored, CASE WHEN C = 10.0 AND split = 'train' THEN true END AS same_as_fit
FROM vsplit CROSS JOIN (VALUES ('rbf'), ('poly'), ('linear')) k(kernel) CROSS JOIN (VALUES {_CS}) c(C)
WHERE split <> 'test' GROUP BY kernel, C, split""")
def svm_c_facts(spark, sf):
    """Every kernel and C scores all rows of both splits; at C = 10 the sweep is the fit of its own."""
    cols = selected_columns(spark, sf)
    own = None
    for kernel in KERNELS:
        p = _pred(spark, sf, fitted_model(spark, sf, "svm", {"kernel": kernel}, cols), ("train",))
        row = p.agg(F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("own")).withColumn("kernel", F.lit(kernel))
        own = row if own is None else own.unionByName(row)
    same = F.when((F.col("C") == 10.0) & (F.col("split") == "train"), F.abs(F.col("accuracy") - F.col("own")) < 1e-12)
    return _sweep(spark, sf).join(F.broadcast(own), "kernel").select(
        "kernel", "C", "split", "n", F.col("accuracy").between(0.0, 1.0).alias("scored"), same.alias("same_as_fit"))


@query("gbt_fit_score")
def gbt_fit_score(spark, sf):
    """M5: level-wise boosting (300 rounds, depth 6, lr 0.1, row and column share 0.8)."""
    return _scored(spark, sf, "boosted")


@query("gbt_early_stop_score")
def gbt_early_stop_score(spark, sf):
    """M6: leaf-wise boosting (up to 300 rounds, 63 leaves, lr 0.05, min 20 per leaf), stopped 50 rounds after the best."""
    return _scored(spark, sf, "boosted_leafwise")


# ---- facts: what must hold of a fit, over all rows, with the row counts from SQL
_BY_LABEL = LEARN_SPLIT_SQL + """
SELECT split, label, count(*) AS n, true AS proba_sums, true AS argmax, CASE WHEN split = 'train' THEN true END AS beats_majority{more}
FROM vsplit WHERE split <> 'val' GROUP BY split, label"""


@query("lr_facts", _BY_LABEL.format(more=", true AS stationary, true AS log_loss_agrees"))
def lr_facts(spark, sf):
    """The prediction table's facts; the gradient vanishes at the coefficients; T1's log-loss is E8's."""
    fitted = fitted_model(spark, sf, "logistic")
    pred = _pred(spark, sf, fitted)
    flat = float(abs(ML.logistic_gradient(fitted, _splits(spark, sf)[0])).max()) < 1e-4
    both = ML.train_record(pred).select("split", F.col("log_loss").alias("a")).join(
        log_loss(pred, ["split"]).select("split", F.col("log_loss").alias("b")), "split")
    agrees = both.select("split", (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("log_loss_agrees"))
    return ML.model_facts(pred).withColumn("stationary", F.lit(flat)).join(agrees, "split")


@query("rf_facts", _BY_LABEL.format(more=", true AS importance_shares, true AS last_prefix_is_forest"))
def rf_facts(spark, sf):
    """Facts of the full forest (200 x 20); its importances are shares; the 200-tree prefix is the forest."""
    fitted = fitted_model(spark, sf, "random_forest", FOREST)
    pred = _pred(spark, sf, fitted)
    imp = fitted.model.importances(spark)
    test = _splits(spark, sf)[1]
    last = ML.tree_prefix_curve(fitted, test, [FOREST["n_estimators"]]).first().accuracy
    own = pred.where("split = 'test'").agg(F.avg((F.col("predicted") == F.col("actual")).cast("double"))).first()[0]
    return ML.model_facts(pred).withColumns({"importance_shares": F.lit(bool((imp >= 0).all() and abs(imp.sum() - 1) < 1e-9)),
                                             "last_prefix_is_forest": F.lit(abs(last - own) < 1e-12)})


@query("svm_facts", LEARN_SPLIT_SQL + """
SELECT kernel, split, label, count(*) AS n, true AS proba_sums, true AS argmax, CASE WHEN split = 'train' THEN true END AS beats_majority
FROM vsplit CROSS JOIN (VALUES ('rbf'), ('poly'), ('linear')) k(kernel) WHERE split <> 'val' GROUP BY kernel, split, label""")
def svm_facts(spark, sf):
    """M3: facts of each kernel's prediction table."""
    cols = selected_columns(spark, sf)
    out = None
    for kernel in KERNELS:
        pred = _pred(spark, sf, fitted_model(spark, sf, "svm", {"kernel": kernel}, cols))
        facts = ML.model_facts(pred).withColumn("kernel", F.lit(kernel))
        out = facts if out is None else out.unionByName(facts)
    return out


def _boost_facts(spark, sf, name):
    """Facts of a boosted model with its curve: the last point is E8 of the predictions, importances are shares."""
    fitted = fitted_model(spark, sf, name)
    booster, par = fitted.model, ML.boost_params(name)
    pred = _pred(spark, sf, fitted, ("test", "train", "val"))
    used, grown = booster.best[0], len(booster.trees[0])
    losses = {(r, s): loss for _, r, s, loss, _ in booster.curve}
    val = [losses[r, "val"] for r in range(1, grown + 1)]
    stopped = grown == par.rounds if not par.patience else (used == min(range(grown), key=val.__getitem__) + 1 and (
        grown == par.rounds or grown == used + par.patience))
    own = {r.split: r.log_loss for r in log_loss(pred, ["split"]).collect()}
    agrees = all(abs(own[s] - losses[used, s]) < 1e-6 for s in ("train", "val"))  # the curve sums losses in steps of 2^-24
    shares = [booster.importances(0, k) for k in ("gain", "split")]
    return ML.model_facts(pred.where("split <> 'val'")).withColumns({
        "rounds_right": F.lit(bool(stopped)), "curve_ends_at_e8": F.lit(bool(agrees)),
        "curve_falls": F.lit(losses[grown, "train"] < losses[1, "train"]),
        "importance_shares": F.lit(all((x >= 0).all() and abs(x.sum() - 1) < 1e-9 for x in shares))})


_BOOST_SQL = _BY_LABEL.format(more=", true AS rounds_right, true AS curve_ends_at_e8, true AS curve_falls, true AS importance_shares")


@query("gbt_facts", _BOOST_SQL)
def gbt_facts(spark, sf):
    """Facts of the level-wise model: 300 rounds, its curve and importances."""
    return _boost_facts(spark, sf, "boosted")


@query("leafwise_facts", _BOOST_SQL)
def leafwise_facts(spark, sf):
    """Facts of the leaf-wise model: it stops 50 rounds after its best validation loss and uses that round."""
    return _boost_facts(spark, sf, "boosted_leafwise")


@query("gbt_loss_curve")
def gbt_loss_curve(spark, sf):
    """Log-loss per round on train and val, level-wise."""
    return ML.loss_curve(fitted_model(spark, sf, "boosted"), spark)


@query("leafwise_loss_curve")
def leafwise_loss_curve(spark, sf):
    """Log-loss per round on train and val up to the early stop, leaf-wise."""
    return ML.loss_curve(fitted_model(spark, sf, "boosted_leafwise"), spark)


@query("loss_curves")
def loss_curves(spark, sf):
    """Logistic objective per iteration, and the fit's log-loss on train and val."""
    fitted = fitted_model(spark, sf, "logistic")
    ends = ML.train_record(_pred(spark, sf, fitted, ("train", "val"))).select(
        "model", F.lit("log_loss").alias("curve_type"), F.lit(1).alias("x"), F.col("split").alias("series"), F.col("log_loss").alias("value"))
    return ML.loss_curve(fitted, spark).unionByName(ends)


PARAMS = {"random_forest": FOREST}


@query("feature_importance")
def feature_importance(spark, sf):
    """Importances of every model that has them."""
    out = None
    for name in ("logistic", "random_forest", *ML.BOOSTED):
        imp = ML.importances(fitted_model(spark, sf, name, PARAMS.get(name)), VEC, spark)
        out = imp if out is None else out.unionByName(imp)
    return out


@query("importance_by_model")
def importance_by_model(spark, sf):
    """Top-15 features per model."""
    return V.top_k_per_group(feature_importance(spark, sf), "model", "importance", IMPORTANCE_TOP_PER_MODEL)


@query("importance_facts", """
SELECT model, 64::BIGINT AS n_features, true AS non_negative, model <> 'logistic' AS sums_to_one, 15::BIGINT AS n_top
FROM (VALUES ('logistic'), ('random_forest'), ('boosted'), ('boosted_leafwise')) t(model)
WHERE (SELECT count(*) FROM embeddings) > 0""")
def importance_facts(spark, sf):
    """Every model reports each column once, none below zero; tree models report shares; 15 columns are charted."""
    imp = feature_importance(spark, sf)
    top = importance_by_model(spark, sf).groupBy("model").agg(F.count("*").alias("n_top"))
    return imp.groupBy("model").agg(F.countDistinct("feature").alias("n_features"), (F.min("importance") >= 0).alias("non_negative"),
                                    (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one")).join(top, "model")


@query("rf_size_curve")
def rf_size_curve(spark, sf):
    """Test accuracy of tree prefixes of ONE 200-tree forest (no refits)."""
    return ML.tree_prefix_curve(fitted_model(spark, sf, "random_forest", FOREST), _splits(spark, sf)[1],
                                [n for n in RF_SIZES if n <= FOREST["n_estimators"]])


def all_predictions(spark, sf):
    """A2: the prediction tables of all six models, test and train rows.

    The models are fitted side by side: boosting a table of this size is one task, so one after the other leaves the other
    cores idle."""
    _splits(spark, sf)  # prepared once, before the models ask for it
    slowest_first = sorted(ML.MODELS, key=lambda name: name not in ML.BOOSTED)
    found = dict(zip(slowest_first, in_threads(
        spark, lambda name: _pred(spark, sf, fitted_model(spark, sf, name, PARAMS.get(name))), slowest_first, len(slowest_first))))
    out = None
    for name in ML.MODELS:
        out = found[name] if out is None else out.unionByName(found[name])
    return hold(out)


@query("model_comparison")
def model_comparison(spark, sf):
    """A2: all six models on one split → comparison rows."""
    return comparison_table(all_predictions(spark, sf))


@query("model_comparison_facts", LEARN_SPLIT_SQL + """
SELECT model, count_if(split = 'test')::BIGINT AS n_test, count_if(split = 'train')::BIGINT AS n_train, true AS accuracy_recomputed,
       true AS gap_recomputed
FROM vsplit CROSS JOIN (VALUES ('logistic'), ('knn'), ('svm'), ('random_forest'), ('boosted'), ('boosted_leafwise')) m(model)
GROUP BY model""")
def model_comparison_facts(spark, sf):
    """A2: the comparison's rows against plain SQL over the prediction tables."""
    pred = all_predictions(spark, sf)
    view = "all_predictions_" + uuid.uuid4().hex
    pred.createOrReplaceTempView(view)
    plain = spark.sql(f"""SELECT model, count_if(split = 'test') AS n_test, count_if(split = 'train') AS n_train,
        avg(CASE WHEN split = 'test' THEN CAST(predicted = actual AS DOUBLE) END) AS a,
        avg(CASE WHEN split = 'train' THEN CAST(predicted = actual AS DOUBLE) END) AS t FROM {view} GROUP BY model""")
    rows = plain.join(comparison_table(pred), "model")
    return rows.select("model", "n_test", "n_train", (F.abs(F.col("a") - F.col("accuracy")) < 1e-12).alias("accuracy_recomputed"),
                       (F.abs(F.col("t") - F.col("train_accuracy")) < 1e-12).alias("gap_recomputed"))


@query("time_vs_accuracy")
def time_vs_accuracy(spark, sf):
    """Train seconds vs accuracy of all six models, bubble size 200 + 20·t."""
    secs = spark.createDataFrame([(n, float(fitted_model(spark, sf, n, PARAMS.get(n)).seconds)) for n in ML.MODELS], "model string, train_seconds double")
    rows = comparison_table(all_predictions(spark, sf)).drop("train_seconds").join(F.broadcast(secs), "model")
    return rows.select("model", "train_seconds", "accuracy", (200 + 20 * F.col("train_seconds")).alias("bubble"))


@query("pca_2d")
def pca_2d(spark, sf):
    """V6: 2-D PCA projection of the standardised vectors."""
    return ML.pca_2d(model_data(spark, sf), VEC, "row_id", "label")


@query("pca_facts", "WITH " + OF.LEARNABLE_VECTORS + """
SELECT label, count(*) AS n, true AS centred, true AS uncorrelated, true AS shares, true AS ordered, true AS largest FROM learnable GROUP BY label""")
def pca_facts(spark, sf):
    """V6: the projection is centred and uncorrelated, its variances are the explained shares, the first is the largest."""
    d = model_data(spark, sf)
    projected = hold(ML.pca_2d(d, VEC, "row_id", "label"))
    facts = ML.pca_facts(projected, d, VEC, "row_id", "label")
    return projected.groupBy("label").agg(F.count("*").alias("n")).withColumns({k: F.lit(bool(v)) for k, v in facts.items()})


# ---- A9 for every model
def _robust(spark, sf, name):
    key = ("robust", spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        tr, te, _ = _splits(spark, sf)
        rows = R.robustness(name, tr.drop("split"), te.drop("split"), VEC, "label", "row_id", PARAMS.get(name)).collect()  # 15 rows
        if missing := [r.label for r in rows if r.accuracy is None]:
            raise RuntimeError(f"robustness_{name}: no score for {', '.join(missing)}")  # not a table with holes
        _FITTED[key] = [tuple(r) for r in rows]
    return spark.createDataFrame(_FITTED[key], "model string, noise_id int, type string, param double, label string, accuracy double")


def _robust_query(name):
    title = f"robustness_{name}"

    @query(title)
    def scores(spark, sf):
        return _robust(spark, sf, name)

    scores.__doc__ = f"A9: accuracy of {name} on clean test rows after training on the clean and 14 noisy copies."

    @query(title + "_facts", "WITH " + OF.LEARNABLE_VECTORS + f""",
{_settings_sql()}
SELECT '{name}' AS model, noise_id, type, param, nlabel_name AS label, true AS scored FROM cfg WHERE (SELECT count(*) FROM learnable) > 0""")
    def facts(spark, sf):
        acc = F.col("accuracy")
        return _robust(spark, sf, name).select("model", "noise_id", "type", "param", "label",
                                               (acc.isNotNull() & (acc >= 0) & (acc <= 1)).alias("scored"))

    facts.__doc__ = f"A9: {name} gives a score for each of the 15 settings."


for _name in ML.MODELS[0], *ML.MODELS[2:]:  # KNN has its own query with a full oracle above
    _robust_query(_name)


# ---- T4 / T5 / T6 / T7: searches over the models' own spaces
def _search(spark, sf, name):
    key = ("search", spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        method, space, n_iter = PARAM_GRIDS[name]
        candidates = TU.grid(space) if method == "grid" else TU.draws(spark, space, n_iter)
        cols = selected_columns(spark, sf)
        rows = TU.search(name, _splits(spark, sf)[0], cols, "label", "row_id", candidates).collect()  # candidates x folds
        _FITTED[key] = [tuple(r) for r in rows]
    return spark.createDataFrame(_FITTED[key], TU.SCORES)


LEARN_FOLD_SQL = LEARN_SPLIT_SQL + f""",
tr AS (SELECT * FROM vsplit WHERE split = 'train'),
trf AS (SELECT * EXCLUDE (cn, rk), (rk % 5)::INTEGER AS fold FROM ({_vec_rank_sql('fold', 'tr')})),
sizes AS (SELECT fold, count(*)::INTEGER AS n FROM trf GROUP BY fold)"""


def _grid_values_sql(space: dict) -> str:
    tables = " CROSS JOIN ".join(f"(VALUES {', '.join(f'({str(v)!r})' for v in values)}) t{i}({name})" for i, (name, values) in enumerate(space.items()))
    return f"cand AS (SELECT * FROM {tables})"


def _draw_values_sql(space: dict, n_iter: int) -> str:
    pick = ", ".join(f"[{', '.join(repr(str(v)) for v in values)}][CAST(floor({u_sql('id', repr('draw|' + name))} * {len(values)}) AS INTEGER) + 1] AS {name}"
                     for name, values in space.items())
    return f"cand AS (SELECT id AS draw, {pick} FROM range({n_iter}) r(id))"


def _search_facts(scores, names):
    """One row per candidate and fold with the rows that were scored; the score is a mean of recalls."""
    return scores.select(*[F.element_at("params", n).alias(n) for n in names], "fold", "n",
                         ((F.col("score") >= 0) & (F.col("score") <= 1)).alias("scored"))


def _search_query(name):
    method, space, n_iter = PARAM_GRIDS[name]
    title = f"{'grid' if method == 'grid' else 'random'}_search_{name}"
    names = list(space)

    @query(title)
    def scores(spark, sf):
        return _search(spark, sf, name).select(*[F.element_at("params", n).alias(n) for n in names], "fold", "n", "score")

    scores.__doc__ = f"{'T4' if method == 'grid' else 'T5'} / T7: 5-fold balanced accuracy of every candidate of {name}."
    values = _grid_values_sql(space) if method == "grid" else _draw_values_sql(space, n_iter)

    @query(title + "_facts", LEARN_FOLD_SQL + f""",
{values}
SELECT {', '.join(names)}, fold, n, true AS scored FROM cand CROSS JOIN sizes""")
    def facts(spark, sf):
        return _search_facts(_search(spark, sf, name), names)

    facts.__doc__ = f"T4 / T5: the candidates of {name}, the rows scored in each fold."


for _name in ("logistic", "random_forest"):
    _search_query(_name)


@query("tuning_best_logistic", """SELECT true AS same_set, true AS same_mean, true AS same_std, 30::BIGINT AS n_candidates
WHERE (SELECT count(*) FROM embeddings) > 0""")
def tuning_best_logistic(spark, sf):
    """T6 over the logistic grid's score table, against plain SQL over the same table."""
    scores = _search(spark, sf, "logistic")
    view = "scores_" + uuid.uuid4().hex
    scores.createOrReplaceTempView(view)
    plain = spark.sql(f"""WITH t AS (SELECT params['C'] AS c, params['solver'] AS s, params['max_iter'] AS i, score FROM {view}),
        m AS (SELECT c, s, i, avg(score) AS a, stddev_pop(score) AS d FROM t GROUP BY c, s, i)
        SELECT *, (SELECT count(*) FROM m) AS n FROM m ORDER BY round(a, 12) DESC, concat('C=', c, ',max_iter=', i, ',solver=', s) LIMIT 1""")
    return TU.best_params(scores).crossJoin(plain).select(
        ((F.col("params")["C"] == F.col("c")) & (F.col("params")["solver"] == F.col("s")) & (F.col("params")["max_iter"] == F.col("i"))).alias("same_set"),
        (F.abs(F.col("mean_score") - F.col("a")) < 1e-12).alias("same_mean"), (F.abs(F.col("std_score") - F.col("d")) < 1e-12).alias("same_std"),
        F.col("n").alias("n_candidates"))


# ---------------------------------------------------------------- A13 / V15: scoring-time summary (measured)
BATCHES = [1, 100, 1000]
REPEATS = 3


def _timings(spark, sf):
    """Time batch scoring (transform + count) of the first n test rows by the fitted logistic model."""
    fitted = fitted_model(spark, sf, "logistic")
    x = ML.assemble(_splits(spark, sf)[1], VEC).orderBy("row_id")
    rows = []
    for b in BATCHES:
        batch = x.limit(b).persist(StorageLevel.MEMORY_AND_DISK)
        n = batch.count()  # the test split may hold fewer rows than the batch asks for
        for r in range(REPEATS):
            t0 = _time.perf_counter()
            fitted.model.transform(batch).count()
            rows.append(("logistic", b, n, r, _time.perf_counter() - t0))
        batch.unpersist()
    return spark.createDataFrame(rows, "model string, batch int, n_rows int, rep int, seconds double")


@query("timing_summary")
def timing_summary(spark, sf):
    """A13 (re-aimed): median seconds of batch scoring at 1 / 100 / 1000 rows, rows per second."""
    return A.timing_summary(_timings(spark, sf))


_TIMES = f"""WITH t AS (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 'model_a' WHEN 1 THEN 'model_b' ELSE 'model_c' END AS model,
         (CASE (o_orderkey // 3) % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 1000 END)::INTEGER AS batch,
         {u_sql('o_orderkey', "'time'")} + 0.001 AS seconds FROM orders),
s AS (SELECT model, batch, least(batch, 500)::INTEGER AS n_rows, quantile_cont(seconds, 0.5) AS median_seconds
      FROM t GROUP BY model, batch)"""


def _keyed_timings(spark, sf):
    """A timing table derived from the orders by keyed values, so that its summary has one right answer."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    model = F.element_at(F.array(*[F.lit(f"model_{x}") for x in "abc"]), (k % 3 + 1).cast("int"))
    batch = F.element_at(F.array(*[F.lit(b) for b in BATCHES]), (F.floor(k / 3) % 3 + 1).cast("int"))
    return o.select(model.alias("model"), batch.alias("batch"), F.least(batch, F.lit(500)).alias("n_rows"),
                    (keyed_uniform("o_orderkey", F.lit("time")) + 0.001).alias("seconds"))


@query("timing_table", _TIMES + """
SELECT *, n_rows / median_seconds AS rows_per_sec, n_rows < batch AS short FROM s""", doubles=("median_seconds", "rows_per_sec"))
def timing_table(spark, sf):
    """The timing summary over a keyed timing table."""
    return A.timing_summary(_keyed_timings(spark, sf))


@query("single_sample_table", _TIMES + "\nSELECT model, median_seconds FROM s WHERE batch = 1", doubles=("median_seconds",))
def single_sample_table(spark, sf):
    """Single-row times of the keyed timing table."""
    return A.timing_summary(_keyed_timings(spark, sf)).where(F.col("batch") == 1).select("model", "median_seconds")


@query("single_sample_times")
def single_sample_times(spark, sf):
    """Single-row scoring time per model (projection of A13)."""
    return A.timing_summary(_timings(spark, sf)).where(F.col("batch") == 1).select("model", "median_seconds")


# ---------------------------------------------------------------- T5: random search (KNN space, keyed draws)
RS_K = KNN_K_VALUES
RS_ITER = 6


def _rs_candidates_sql() -> str:
    ks = ", ".join(f"({k})" for k in RS_K)
    ws = ", ".join(f"('{w}')" for w in GRID_WEIGHTS)
    return (f"cand AS (SELECT k, w FROM (SELECT a.k, b.w FROM (VALUES {ks}) a(k) CROSS JOIN (VALUES {ws}) b(w)) "
            f"ORDER BY {u_sql(chr(40) + 'CAST(k AS VARCHAR) || ' + repr('|') + ' || w' + chr(41), repr('rs'))}, k, w "
            f"LIMIT {RS_ITER})")


def _random_sql() -> str:
    g = _grid_sql(("euclidean",))
    start = g.index("grid AS (")
    end = g.index("\n", start)
    return g[:start] + _rs_candidates_sql() + ",\ngrid AS (SELECT k, w FROM cand)," + g[end + 1:].lstrip()


@query("random_search", _random_sql() + "\nSELECT * FROM scores", doubles=("score",))
def random_search(spark, sf):
    """T5 (re-aimed to the KNN space): 6 keyed draws from k x weights, 5-fold balanced accuracy."""
    s = vector_splits(spark, sf).where(F.col("split") == "train")
    return MD.knn_random_scores(s, "row_id", VEC, "label", RS_K, GRID_WEIGHTS, RS_ITER, folds=5)
