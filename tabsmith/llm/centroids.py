"""Centroid clustering with a vantage-point tree over the centroids.

Each round builds the tree anew from the round's centroids and broadcasts it (a tree of k centroids, so its size is
known). Every vector searches it best-first: of its open nodes it takes the one with the smallest lower bound, and a node
whose bound exceeds the best distance so far is cut off. The radius is inclusive, a bound equal to the best distance is
still visited, so that ties go to the smaller centroid number. Distances to centroids are exact integers; the bounds are
floats made smaller by more than their rounding error. A task searches for many vectors at once, each with its own queue
and radius, and hands back sums and counts per centroid, so a cluster of a third of all rows is k rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import checkpointed, q, read

LIMIT = 1 << 27  # components below this keep squared distances of 64 of them inside 64 bits
SLACK = 1e-9  # relative; float distances are off by about 1e-15


class VPTree:
    """Vantage-point tree over integer centroids, as flat arrays.

    A node has a vantage centroid and up to two children; a child lists the least and greatest distance of its centroids
    from the vantage centroid. A leaf has up to ``leaf`` centroids, all compared.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = 2):
        self.points = centroids.astype(np.int64)
        self.vantage: list[int] = []  # per node; -1: a leaf
        self.members: list[list[int]] = []  # of a leaf
        self.children: list[list[tuple[int, float, float]]] = []
        if len(centroids):
            self._build(list(range(len(centroids))), leaf)

    def _build(self, ids: list[int], leaf: int) -> int:
        node = len(self.vantage)
        self.vantage.append(-1)
        self.members.append([])
        self.children.append([])
        if len(ids) <= leaf:
            self.members[node] = ids
            return node
        spread = self.points[ids] - self.points[ids].mean(axis=0)
        v = ids[int(np.argmax((spread * spread).sum(axis=1)))]  # the farthest from the middle separates the others best
        rest = [i for i in ids if i != v]
        far = np.sqrt(squared(self.points[rest], self.points[v]).astype(np.float64))
        order = np.argsort(far, kind="stable")
        half = len(rest) // 2
        self.vantage[node] = v
        for part in (order[:half], order[half:]):
            if len(part):
                child = self._build([rest[i] for i in part], leaf)
                self.children[node].append((child, float(far[part].min()), float(far[part].max())))
        return node

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance) of each row, ties to the smaller number, and how many distances were taken."""
        n, nodes = len(rows), len(self.vantage)
        rows = rows.astype(np.int64)
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.full(n, len(self.points), dtype=np.int64)
        queue = np.full((n, nodes), np.inf)  # lower bound of each open node; inf: not open
        if n and nodes:
            queue[:, 0] = 0.0
        taken = 0
        active = np.arange(n)
        while len(active) and nodes:
            bound = queue[active]
            at = bound.argmin(axis=1)
            low = bound[np.arange(len(active)), at]
            go = low * (1 - SLACK) <= np.sqrt(best[active].astype(np.float64))  # inclusive: equal bounds are visited
            go &= np.isfinite(low)
            active, at, low = active[go], at[go], low[go]
            queue[active, at] = np.inf
            for node in np.unique(at):
                here = at == node
                who_here, low_here = active[here], low[here]
                v = self.vantage[node]
                for c in self.members[node] if v < 0 else [v]:
                    d = squared(rows[who_here], self.points[c])
                    taken += len(d)
                    better = (d < best[who_here]) | ((d == best[who_here]) & (c < who[who_here]))
                    best[who_here[better]], who[who_here[better]] = d[better], c
                if v >= 0:
                    root = np.sqrt(d.astype(np.float64))
                    for child, near, far in self.children[node]:
                        gap = np.maximum(np.maximum(root - far, near - root), 0.0)
                        gap = np.maximum(gap - SLACK * (root + far), 0.0)  # below the true gap whatever the rounding
                        queue[who_here, child] = np.maximum(gap, low_here)
        return who, best, taken


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of integer rows to an integer point."""
    diff = rows - point
    return np.einsum("ij,ij->i", diff, diff)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


CHUNK = 4096  # rows searched at once


def _searched(tree: VPTree, batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(0, batch.num_rows, CHUNK):
        part = batch.slice(i, CHUNK)
        rows = _matrix(part.column(part.schema.names.index("vec")), dims)
        who, best, _ = tree.nearest(rows)
        yield part, rows, who, best


def _partial_sums(shared, dims: int):
    """Per task: one row per centroid that has vectors there, with count and componentwise sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: VPTree = shared.value
        counts = np.zeros(len(tree.points), dtype=np.int64)
        sums = np.zeros((len(tree.points), dims), dtype=np.int64)
        for batch in batches:
            for _, rows, who, _ in _searched(tree, batch, dims):
                counts += np.bincount(who, minlength=len(counts))
                for c in np.unique(who):
                    sums[c] += rows[who == c].sum(axis=0, dtype=np.int64)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": have.astype(np.int32), "rows": counts[have], "sums": sums[have].tolist()},
                                         schema=pa.schema([("cluster", pa.int32()), ("rows", pa.int64()), ("sums", pa.list_(pa.int64()))]))
    return run


def _assigned(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: VPTree = shared.value
        for batch in batches:
            for part, _, who, best in _searched(tree, batch, dims):
                yield pa.RecordBatch.from_arrays([part.column(part.schema.names.index("id")), pa.array(who.astype(np.int32)),
                                                  pa.array(best)], names=["id", "cluster", "distance"])
    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, vec) of the vectors with exactly ``dims`` components, none null or non-finite, as integers floor(scale x)."""
    v = F.col(q(vec_col))
    whole = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(v, lambda x: x.cast("double") * scale)
    wide = F.exists(scaled, lambda x: F.abs(x) >= LIMIT)
    checked = F.when(wide, F.raise_error(F.lit(f"a component beyond {LIMIT} after scaling: distances would leave 64 bits"))).otherwise(
        F.transform(scaled, lambda x: F.floor(x).cast("int")))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col(q(id_col)).cast("long").alias("id"), checked.alias("vec"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``; equal ids are ordered by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r.vec for r in rows.select(key.alias("key"), "vec").orderBy("key", "vec").limit(k).collect()], dtype=np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 1024,
            k: int = 8, rounds: int = 10, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every usable vector, the final centroids).

    Components become floor(scale x). Vectors that are null, have another number of components, or hold a null or
    non-finite one take no part. Each round assigns every vector to its nearest centroid (squared Euclidean distance,
    ties to the smaller number) and moves each centroid that has vectors to the floor of their mean; one without any
    stays. Repeated rows count each; rows with a null id are clustered like others. Fewer than ``k`` usable vectors give
    as many centroids, none an empty result. Other columns are not read, whatever their names. A component of 2^27 or
    more after scaling raises an error, since squared distances would leave 64 bits. The driver sees k rows a round.
    """
    spark = vectors.sparkSession
    rows = checkpointed(usable(vectors, id_col, vec_col, dims, scale))
    centroids = first_centroids(rows, k, seed)
    schema = "cluster int, rows long, sums array<long>"
    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(VPTree(centroids))
        parts = rows.mapInArrow(_partial_sums(shared, dims), schema)
        totals = parts.groupBy("cluster").agg(F.sum("rows").alias("rows"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
        moved = centroids.copy()
        for r in totals.collect():  # at most k rows
            moved[r.cluster] = [r[f"s{i}"] // r.rows for i in range(dims)]
        shared.unpersist()
        if (moved == centroids).all():
            break  # nothing moves any more, so the rounds left would repeat this one
        centroids = moved
    shared = spark.sparkContext.broadcast(VPTree(centroids))
    return rows.mapInArrow(_assigned(shared, dims), "id long, cluster int, distance long"), centroids


def op13_vptree_centroids(spark, sf_dir: str) -> DataFrame:
    import hashlib

    found, centroids = cluster(read(spark, sf_dir, "embeddings"))
    found = checkpointed(found)
    digests = spark.createDataFrame(
        pd.DataFrame({"cluster": np.arange(len(centroids), dtype=np.int32),
                      "centroid_sha256": [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]}),
        "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    facts = digests.join(sums, "cluster").crossJoin(F.broadcast(total))  # k rows and one row
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS i, unnest(e) AS x FROM v),
s AS (SELECT r, (row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), e) - 1)::INTEGER AS c FROM v),
c0 AS MATERIALIZED (SELECT c, i, x FROM s JOIN x USING (r) WHERE c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS (SELECT x.r, c.c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{n} c USING (i) GROUP BY x.r, c.c),
a{n} AS MATERIALIZED (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT c, i, sum(x.x)::BIGINT AS s, count(*) AS n FROM a{n} JOIN x USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (
  SELECT o.c, o.i, CASE WHEN m.n IS NULL THEN o.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{n} o LEFT JOIN m{n} m USING (c, i))""")
    return "WITH " + ",\n".join(steps) + f""",
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)
"""


OP13_SQL = _op13_sql()
