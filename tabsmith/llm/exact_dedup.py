"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 turns each text's SHA-256 into a few cells of a bit array and keeps, as Bloom filter, the cells that two or more
rows hit. Pass 2 probes that filter: a row whose cells are not all set has a text of its own and passes straight
through; only the others (repeated texts and the filter's few false positives) shuffle and are grouped by their SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import SPACE, attach, checkpointed, packed, q, text_or_empty, unpacked

BITMAP_BITS = 32768  # bits in one value of bitmap_construct_agg (4,096 bytes)
OUTS = ["keep_id", "group_size", "kept", "text_sha256"]


def text_sha256(text: str | Column) -> Column:
    """Lower-case hex SHA-256 of the text with every run of white space made one space; null counts as empty."""
    return F.sha2(F.regexp_replace(text_or_empty(text), SPACE, " ").cast("binary"), 256)


def filter_bits(n_rows: int, bits_per_row: int, max_filter_bits: int) -> int:
    """Power of two from one bitmap up to ``max_filter_bits``."""
    bits = BITMAP_BITS
    while bits < n_rows * bits_per_row and bits * 2 <= max_filter_bits:
        bits *= 2
    return bits


def _cell(hash_col: str, j: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(hash_col), F.lit(j)), F.lit(bits))


def repeated_cells(hashes: DataFrame, hash_col: str, bits: int, n_hash: int) -> DataFrame:
    """Pass 1: (filter, bucket, bitmap) of the cells that at least two rows hit; at most n_hash * bits / 8 bytes."""
    cells = hashes.select(F.explode(F.array(*[
        F.struct(F.lit(j).alias("filter"), _cell(hash_col, j, bits).alias("cell")) for j in range(n_hash)])).alias("c"))
    hit_twice = cells.groupBy("c.filter", "c.cell").count().filter("count > 1")
    return (hit_twice.groupBy("filter", F.expr(f"cell div {BITMAP_BITS}").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("cell") % BITMAP_BITS).alias("bitmap")))


def probe(rows: DataFrame, hash_col: str, cells: DataFrame, bits: int, n_hash: int) -> DataFrame:
    """Pass 2: add ``_maybe``, true if all cells of the row's hash are set. No shuffle: the filter is broadcast."""
    hits = []
    for j in range(n_hash):
        part = cells.filter(F.col("filter") == j).select(
            F.col("bucket").alias(f"_bucket{j}"), F.col("bitmap").alias(f"_bitmap{j}"))
        rows = rows.withColumn(f"_cell{j}", _cell(hash_col, j, bits))
        rows = rows.join(F.broadcast(part), F.expr(f"_cell{j} div {BITMAP_BITS}") == F.col(f"_bucket{j}"), "left")
        byte = f"cast(conv(hex(substring(_bitmap{j}, cast((_cell{j} % {BITMAP_BITS}) div 8 as int) + 1, 1)), 16, 10) as int)"
        hits.append(F.coalesce(F.expr(f"shiftright({byte}, cast(_cell{j} % 8 as int)) & 1"), F.lit(0)) == 1)
    maybe = hits[0]
    for h in hits[1:]:
        maybe = maybe & h
    return rows.withColumn("_maybe", maybe).drop(
        *[f"_{x}{j}" for j in range(n_hash) for x in ("cell", "bucket", "bitmap")])


def dedup_hashed(rows: DataFrame, bits_per_row: int = 8, n_hash: int = 2, max_filter_bits: int = 1 << 28) -> DataFrame:
    """Dedup rows (_id, _sha, any others) by _sha; adds OUTS and keeps every row.

    The filter grows with the rows up to ``max_filter_bits`` (two bitmaps of 32 MB at the default). Past that bound
    more rows that are not repeated take the shuffle; the result is the same.
    """
    rows = rows.withColumn("_rid", F.monotonically_increasing_id())
    n = rows.count()
    bits = filter_bits(n, bits_per_row, max_filter_bits)
    cells = checkpointed(repeated_cells(rows.select("_sha"), "_sha", bits, n_hash))
    probed = probe(rows, "_sha", cells, bits, n_hash)
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_rid").alias("rid"))
    maybe = probed.filter("_maybe")
    groups = checkpointed(maybe.groupBy("_sha").agg(F.count("*").alias("group_size"), F.min(order).alias("_first")))
    alone = probed.filter("not _maybe").select(
        *rows.columns, F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"))
    grouped = attach(maybe, groups, "_sha", "group_size", n).select(
        *rows.columns, F.col("_first.id").alias("keep_id"), "group_size",
        (F.col("_rid") == F.col("_first.rid")).alias("kept"), F.col("_sha").alias("text_sha256"))
    return alone.unionByName(grouped)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after each run of white space became one space; a null text counts as
    empty and equals the empty text, and any other empty or all-space text only its like (one space stays one space).
    Of equal texts the row with the smallest id stays; a null id comes after all others. Of rows that repeat both id
    and text exactly one stays. An empty table gives an empty result. An input column named like one of the four
    outputs is replaced; every other column is carried along unchanged. ``docs`` is evaluated several times and must
    give the same rows in the same partitions each time, as a table scan or a checkpoint does.
    """
    rows = docs.select(packed(docs).alias("_row"), F.col(q(id_col)).alias("_id"), text_sha256(text_col).alias("_sha"))
    return unpacked(dedup_hashed(rows, **sizes), docs.columns, OUTS)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with the columns of ``docs``."""
    rows = docs.select(packed(docs).alias("_row"), F.col(q(id_col)).alias("_id"), text_sha256(text_col).alias("_sha"))
    return unpacked(dedup_hashed(rows, **sizes).filter("kept"), docs.columns, [])


def op7_bloom_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from tabsmith.llm.common import read

    docs = read(spark, sf_dir, "documents")
    # only ids and hashes are wanted: read and hash the texts once and go on from the narrow rows
    rows = checkpointed(docs.select(F.col("doc_id").alias("_id"), text_sha256("text").alias("_sha")))
    return dedup_hashed(rows).select(F.col("_id").alias("doc_id"), *OUTS)


OP7_SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents)
WINDOW w AS (PARTITION BY sha)
"""
