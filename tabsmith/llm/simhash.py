"""SimHash near-duplicates: 64-bit fingerprints, pigeonring candidate search, connected components.

Pigeonring: cut the 64 bits into m segments on a ring. If two fingerprints differ in at most t bits, some segment starts
a chain in which, for every length l, the first l segments together differ in at most l * t / m bits. So the search
looks up chains by their leading segments and drops a pair at the first length whose budget it exceeds, before the full
64-bit distance is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import attach, checkpointed, packed, q, read, unpacked
from tabsmith.llm.graph import connected_components

SEED = 42
SEGMENTS = 4  # of 16 bits; with a distance of 2, chains have two equal segments among the first three
WIDTH = 64 // SEGMENTS
CHUNK = 1 << 15  # shingles whose bits are unpacked at once (2 MB)


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of one whole text, over every shingle, repeats included; 0 if there is no word."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z only, splits at 20, 09-0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in spans), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(shingle: int):
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            values = np.fromiter((fingerprint(t, shingle) for t in s), dtype=np.uint64, count=len(s))
            yield pd.Series(values.view(np.int64))

    return fp


def _segment(fp: str, i: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), WIDTH * (i % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def _keys(max_bits: int) -> list[tuple[int, int]]:
    """Segment pairs that are equal in some admissible chain.

    Each chain of budgets l * t / m with t < m starts with an equal segment; its second and third segments together may
    differ in floor(3 t / m) bits, so for t <= 2 a second equal segment is next to the first or one further.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("this segment layout is exact for 0 to 2 differing bits")
    return sorted({tuple(sorted((i, (i + d) % SEGMENTS))) for i in range(SEGMENTS) for d in (1, 2)})


def _chain(a: str, b: str, max_bits: int) -> Column:
    """True if from some start every prefix of the ring of segments keeps within its share of the distance."""
    diff = [F.bit_count(_segment(a, i).bitwiseXOR(_segment(b, i))) for i in range(SEGMENTS)]
    some = F.lit(False)
    for start in range(SEGMENTS):
        run, ok = F.lit(0), F.lit(True)
        for length in range(1, SEGMENTS + 1):
            run = run + diff[(start + length - 1) % SEGMENTS]
            ok = ok & (run <= length * max_bits // SEGMENTS)
        some = some | ok
    return some


def fingerprint_links(fps: DataFrame, max_bits: int, bucket_rows: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) at ``max_bits`` or fewer differing bits.

    Each fingerprint is filed under the segment pairs of ``_keys``. In a bucket of up to ``bucket_rows`` fingerprints
    pairs meet, pass the pigeonring chains and then the full distance. In a larger bucket no pairs are made: every
    fingerprint lists itself and its one-bit neighbours outside the bucket's two segments; two members within two bits
    share such a point, and all that share one are within two bits of each other, so a link from each to the smallest
    there loses no connection. That list has at most 1 + 32 entries per fingerprint. Links may repeat.
    """
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), _segment("fp", i).alias("x"), _segment("fp", j).alias("y"))
        for n, (i, j) in enumerate(_keys(max_bits))])).alias("k"))
    sizes = checkpointed(keyed.groupBy("k").agg(F.count("*").alias("rows")).filter("rows > 1"))
    small = keyed.join(sizes.filter(F.col("rows") <= bucket_rows), "k")
    left = small.select("k", F.col("fp").alias("a"))
    right = small.select(F.col("k").alias("k2"), F.col("fp").alias("b"))
    pairs = left.join(right, (F.col("k") == F.col("k2")) & (F.col("a") < F.col("b")) & _chain("a", "b", max_bits)
                      & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    if max_bits == 0:
        return pairs
    n_keyed = int(sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])  # lower than all rows: hot a little earlier
    large = attach(keyed, sizes.filter(F.col("rows") > bucket_rows), "k", "rows", n_keyed).select("fp", "k.n")
    flips = F.lit(None)
    for n, pair in enumerate(_keys(max_bits)):
        free = [b for b in range(64) if b // WIDTH not in pair]
        masks = [0] + [(1 << b) - (1 << 64 if b == 63 else 0) for b in free]
        flips = F.when(F.col("n") == n, F.array(*[F.lit(m).cast("long") for m in masks])).otherwise(flips)
    points = large.select("n", "fp", F.explode(flips).alias("mask")).select(
        "n", "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    if max_bits == 1:  # only a member's own point links its one-bit neighbours
        own = large.select("n", F.col("fp").alias("b"))
        stars = points.join(own, (points.n == own.n) & (F.col("point") == F.col("b")) & (F.col("fp") != F.col("b")))
        return pairs.unionByName(stars.select(F.col("fp").alias("a"), "b"))
    low = points.groupBy("n", "point").agg(F.min("fp").alias("b"), F.count("*").alias("rows")).filter("rows > 1")
    stars = points.join(low, ["n", "point"]).filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.unionByName(stars)


def classes_of(prints: DataFrame, max_bits: int) -> DataFrame:
    """Rows (_id, fp, any others) with ``fp_hex`` and ``root_id`` (smallest id of the class).

    Rows of one fingerprint collapse to one node first, so copies are never expanded into pairs.
    """
    n = prints.count()
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("_id").alias("low"), F.count("*").alias("rows")))
    links = fingerprint_links(nodes.select("fp"), max_bits)  # repeats go in connected_components
    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").select("fp", "low", "rows", F.coalesce("root", "fp").alias("root"))
    rooted = checkpointed(rooted)
    lows = checkpointed(rooted.groupBy("root").agg(F.min("low").alias("root_id"), F.count("*").alias("members")))
    table = checkpointed(attach(rooted, lows, "root", "members", n).select("fp", "rows", "root_id"))
    return attach(prints, table, "fp", "rows", n).withColumn("fp_hex", F.lower(F.lpad(F.hex("fp"), 16, "0"))).drop("rows")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are the runs without white space of the text with A-Z lower-cased; a text of fewer words than ``shingle``
    counts as one shingle, and null, empty and all-space texts have fingerprint zero and link like any other.
    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` bits (null only if every id of the
    class is null). Repeated rows appear once each; other columns are not read. An empty table gives an empty result.
    """
    prints = checkpointed(docs.select(F.col(q(id_col)).alias("_id"), fingerprint_column(shingle)(F.col(q(text_col))).alias("fp")))
    return classes_of(prints, max_bits).select(
        F.col("_id").alias(id_col), F.col("fp_hex").alias("fingerprint"), F.col("root_id").alias("component_id"))


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` without those of a near-duplicate class but one, the smallest (id, text hash).

    Ids need not be unique: a row is known by id and text hash; rows that repeat both are one document and one stays.
    A null id comes after the others. Columns are those of ``docs``.
    """
    text = F.col(q(text_col))
    mark = F.xxhash64(text.cast("string"))
    prints = checkpointed(docs.select(
        F.struct(F.col(q(id_col)).isNull().alias("none"), F.coalesce(F.col(q(id_col)).cast("string"), F.lit("")).alias("key"),
                 F.col(q(id_col)).alias("id"), mark.alias("mark")).alias("_id"),
        fingerprint_column(shingle)(text).alias("fp")).select(
            F.struct("_id.none", "_id.id", "_id.key", "_id.mark").alias("_id"), "fp"))
    classes = classes_of(prints, max_bits)
    dropped = checkpointed(classes.filter("_id <> root_id").select("_id.none", "_id.key", "_id.mark").distinct())
    rows = docs.select(packed(docs).alias("_row"), F.col(q(id_col)).isNull().alias("none"),
                       F.coalesce(F.col(q(id_col)).cast("string"), F.lit("")).alias("key"), mark.alias("mark"))
    left = rows.join(dropped, ["none", "key", "mark"], "left_anti")
    if prints.groupBy("_id").count().filter("count > 1").limit(1).count():
        left = left.dropDuplicates(["none", "key", "mark"])
    return unpacked(left, docs.columns, [])


def op3_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_classes(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)
