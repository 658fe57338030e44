"""Exact top-k search by the three-phase uniform threshold.

A vector's score is the sum of the partial scores of a few segments of its components. Phase 1: every node (a block of
queries against a block of candidates) gathers, per query and segment, the k candidates with the highest partial score,
and hands back the totals of those. The k-th highest total of all nodes is a safe cutoff t: the k-th best score cannot
be lower. Phase 2: the cutoffs go back to the nodes; with m segments, a candidate that reaches t in total reaches t / m
in at least one, so only such candidates are collected, and dropped again as soon as their known partial scores and the
most that the others can add stay below t. Phase 3: the missing partial scores of those left are resolved exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import checkpointed, q, read

SCALE = 64
LIST = "query_key long, query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(key, id, vec) of vectors without null or non-finite components; key tells rows with one id apart."""
    v = F.col(q(vec_col))
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(
        F.col(q(id_col)).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("vec"))


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of rows → its keys, ids and row-major int64 matrix (shorter vectors end in zeros)."""
    pdf = pdf.sort_values("key")
    dims = int(pdf["dims"].iloc[0])
    m = np.zeros((len(pdf), dims), dtype="<i8")
    for i, v in enumerate(pdf["vec"]):
        m[i, :len(v)] = v
    kind = next((t for t in ("<i1", "<i2", "<i4") if m.size == 0 or (m.min() >= np.iinfo(t).min and m.max() <= np.iinfo(t).max)), "<i8")
    none = pdf["id"].isna().to_numpy()
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "dims": [dims], "kind": [kind],
                         "keys": [pdf["key"].to_numpy("<i8").tobytes()],
                         "ids": [pdf["id"].fillna(0).astype("int64").to_numpy("<i8").tobytes()],
                         "none": [none.tobytes()], "matrix": [m.astype(kind).tobytes()]})


PACKED = "block long, dims long, kind string, keys binary, ids binary, none binary, matrix binary"


def _blocks(rows: DataFrame, size: int, n: int) -> tuple[DataFrame, int]:
    count = max(1, -(-n // size))
    return rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count))).groupBy("block").applyInPandas(_pack, PACKED), count


def _open(row, side: str):
    dims = int(row[f"{side}_dims"])
    keys = np.frombuffer(row[f"{side}_keys"], "<i8")
    m = np.frombuffer(row[f"{side}_matrix"], row[f"{side}_kind"]).reshape(len(keys), dims)
    return keys, np.frombuffer(row[f"{side}_ids"], "<i8"), np.frombuffer(row[f"{side}_none"], bool), m


def _exact_type(a: np.ndarray, b: np.ndarray):
    """The fastest type in which every sum of products of these integers is exact."""
    top = lambda m: max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
    bound = top(a) * top(b) * max(1, a.shape[1])
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def _partials(q_m: np.ndarray, c_m: np.ndarray, segments: int) -> list[np.ndarray]:
    kind = _exact_type(q_m, c_m)
    cuts = np.linspace(0, q_m.shape[1], segments + 1).astype(int)
    a, b = q_m.astype(kind), c_m.astype(kind)
    return [a[:, x:y] @ b[:, x:y].T for x, y in zip(cuts[:-1], cuts[1:])]


def _local_lists(k: int, segments: int):
    """Phase 1 at a node: totals of the candidates in the query's per-segment lists, the k highest of them."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, row in pdf.iterrows():
                qk, _, _, qm = _open(row, "q")
                ck, _, _, cm = _open(row, "c")
                parts = _partials(qm, cm, segments)
                own = qk[:, None] == ck[None, :]
                total = sum(parts[1:], parts[0].copy())
                listed = np.zeros(total.shape, dtype=bool)
                take = min(k + 1, len(ck))  # one more: the query's own row may be among them
                for p in parts:
                    listed[np.arange(len(qk))[:, None], np.argpartition(-p, take - 1, axis=1)[:, :take]] = True
                listed &= ~own
                i, j = np.nonzero(listed)
                s = np.array([int(x) for x in total[i, j]], dtype="int64")
                out = pd.DataFrame({"query_key": qk[i], "score": s}).sort_values(["query_key", "score"], ascending=[True, False])
                yield out[out.groupby("query_key").cumcount() < k]
    return run


def _collect(k: int, segments: int):
    """Phases 2 and 3 at a node: candidates that reach t / m somewhere, pruned by bounds, then resolved exactly."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, row in pdf.iterrows():
                qk, qi, _, qm = _open(row, "q")
                ck, ci, none, cm = _open(row, "c")
                keys = np.frombuffer(row["cut_keys"], "<i8")
                cuts = np.full(len(qk), np.iinfo("int64").min, dtype="int64")  # no cutoff: fewer than k candidates in all
                if len(keys):
                    where = np.clip(np.searchsorted(keys, qk), 0, len(keys) - 1)
                    found = keys[where] == qk
                    cuts[found] = np.frombuffer(row["cut_scores"], "<i8")[where[found]]
                parts = _partials(qm, cm, segments)
                t = cuts.astype(object if parts[0].dtype == object else np.float64)[:, None]
                share = t // segments  # rounded down: never above the true share
                hit = np.zeros(parts[0].shape, dtype=bool)
                for p in parts:
                    hit |= p >= share
                hit &= qk[:, None] != ck[None, :]
                if none.any():
                    hit[:, none] = False
                i, j = np.nonzero(hit)
                most = [p.max(axis=1) for p in parts]
                known = np.zeros(len(i), dtype=parts[0].dtype)
                for n, p in enumerate(parts):  # a partial score at a time, dropping what cannot reach t any more
                    known = known + p[i, j]
                    rest = sum((m[i] for m in most[n + 1:]), np.zeros(len(i), dtype=known.dtype))
                    keep = np.asarray(known + rest >= t[i, 0], dtype=bool)
                    i, j, known = i[keep], j[keep], known[keep]
                out = pd.DataFrame({"query_key": qk[i], "query_id": qi[i], "vec_id": ci[j],
                                    "score": np.array([int(x) for x in known], dtype="int64")})
                out = out.sort_values(["query_key", "score", "vec_id"], ascending=[True, False, True])
                yield out[out.groupby("query_key").cumcount() < k]
    return run


def _pack_cuts(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("query_key")
    return pd.DataFrame({"q_block": [int(pdf["q_block"].iloc[0])], "cut_keys": [pdf["query_key"].to_numpy("<i8").tobytes()],
                         "cut_scores": [pdf["score"].to_numpy("<i8").tobytes()]})


def _ranked(lists: DataFrame, k: int, *order) -> DataFrame:
    w = Window.partitionBy("query_key").orderBy(*order)
    return lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
          segments: int = 4, query_block: int = 512, candidate_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): per query row its ``k`` highest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on the id column (as column ``id``). Components become floor(64 x). Vectors that are
    null or hold a null or non-finite component take no part. Vectors shorter than the longest end in zeros (an empty
    one scores 0). Every other row is a candidate, also one that repeats the query's id or vector; only the query's own
    row is not. Rows with a null id are neither query nor candidate. Fewer than ``k`` candidates give them all, an empty
    table no row. Other columns are not read. Queries meet candidates in blocks whose sizes are fixed, so a task's
    memory is; a node hands back at most k rows per query however many tie. Scores past 64 bits raise OverflowError.
    """
    rows = usable(vectors, id_col, vec_col).filter("id is not null")
    rows = checkpointed(rows.withColumn("key", F.monotonically_increasing_id()))
    n, dims = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    rows = rows.withColumn("dims", F.lit(int(dims or 0)).cast("long"))
    queries = rows.filter(F.coalesce(is_query, F.lit(False)))
    n_queries = queries.count()
    c_packed, nc = _blocks(rows, candidate_block, n)
    q_packed, nq = _blocks(queries, query_block, n_queries)
    pre = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    c_packed, q_packed = checkpointed(pre(c_packed, "c")), checkpointed(pre(q_packed, "q"))
    # every block of queries meets every block of candidates under a key of both numbers
    left = q_packed.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)).cast("array<long>")))
    right = c_packed.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<long>")))
    tasks = nc * nq
    met = left.repartition(tasks, "q_block", "c_block").join(right.repartition(tasks, "q_block", "c_block"), ["q_block", "c_block"])
    lists = met.mapInPandas(_local_lists(k, segments), "query_key long, score long")
    cutoff = _ranked(lists, k, F.col("score").desc()).filter(F.col("rank") == k).select("query_key", "score")
    cutoff = cutoff.withColumn("q_block", F.pmod(F.xxhash64("query_key"), F.lit(nq)))
    cuts = checkpointed(cutoff.groupBy("q_block").applyInPandas(_pack_cuts, "q_block long, cut_keys binary, cut_scores binary"))
    empty = F.lit(b"").cast("binary")
    with_cuts = q_packed.join(cuts, "q_block", "left").withColumns(
        {"cut_keys": F.coalesce("cut_keys", empty), "cut_scores": F.coalesce("cut_scores", empty)})
    left = with_cuts.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)).cast("array<long>")))
    met = left.repartition(tasks, "q_block", "c_block").join(right.repartition(tasks, "q_block", "c_block"), ["q_block", "c_block"])
    found = met.mapInPandas(_collect(k, segments), LIST)
    best = _ranked(found, k, F.col("score").desc(), F.col("vec_id"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_topk_uniform_threshold(spark, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


OP8_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.k, a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.k <> b.k)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, (row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
WHERE rank <= 20
"""
