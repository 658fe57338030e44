"""Benchmark decontamination by a prefix-filtered set join.

Every window of an item (``window`` consecutive words; a shorter item is one window) is a set of word shingles. Shingles
are ordered by rarity in the documents, counted over all of them. A stretch of a document that holds c of a window's n
shingles must hold one of the window's n - c + 1 rarest, its prefix, so only these are joined. A shared prefix shingle
fixes where the window would stand (positional bound) and whether it fits into the document there (length bound); what
is left is verified word by word over a stretch of the window's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabsmith.llm.common import attach, checkpointed, q, read
from tabsmith.llm.shingles import mix, shingle_hashes, texts, words_of_bytes, words_text

CELL_BITS = 16  # a filter is made of bitmaps of 2^16 bits
PROBES = 3


class ShingleFilter:
    """Bloom filter over 64-bit hashes: lets a scan pass over shingles that no window has before anything is shuffled."""

    def __init__(self, log_bits: int, cells: list[tuple[int, bytes]]):
        self.log_bits = log_bits
        self.bits = np.zeros(1 << (log_bits - 3), dtype=np.uint8)
        for cell, bitmap in cells:
            self.bits[cell << (CELL_BITS - 3):(cell + 1) << (CELL_BITS - 3)] = np.frombuffer(bitmap, np.uint8)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be in the filter."""
        at = np.arange(len(hashes))
        for i in range(PROBES):
            p = place(self.log_bits, hashes[at], i)
            at = at[(self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
        return at


def place(log_bits: int, hashes: np.ndarray, probe: int) -> np.ndarray:
    """Bit numbers of the hashes in probe 0, 1, ..."""
    h = mix(hashes + np.uint64(probe)) if probe else hashes
    return (h >> np.uint64(64 - log_bits)).astype(np.int64)


def _bitmaps(log_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            p = np.concatenate([place(log_bits, h, i) for i in range(PROBES)])
            yield pa.RecordBatch.from_arrays([pa.array(p >> CELL_BITS), pa.array((p & ((1 << CELL_BITS) - 1)).astype(np.int32))],
                                             names=["cell", "bit"])
    return run


def _pack_cell(pdf):
    bits = np.zeros(1 << CELL_BITS, dtype=bool)
    bits[pdf["bit"].to_numpy()] = True
    return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "bitmap": [np.packbits(bits, bitorder="little").tobytes()]})


def shingle_filter(shingles: DataFrame, max_log_bits: int):
    """Broadcast filter of the long column ``shingle``: 32 to 64 bits for each, at most 2^max_log_bits bits in all.

    Past that bound more foreign shingles pass and are shuffled, and the join drops them: the result is the same.
    """
    n = shingles.count()
    log_bits = int(min(max_log_bits, max(CELL_BITS, np.ceil(np.log2(max(1, n) * 32)))))
    bits = shingles.select("shingle").mapInArrow(_bitmaps(log_bits), "cell long, bit int").distinct()
    cells = bits.groupBy("cell").applyInPandas(_pack_cell, "cell long, bitmap binary").collect()  # at most the filter's size
    made = ShingleFilter(log_bits, [(c.cell, bytes(c.bitmap)) for c in cells])
    return shingles.sparkSession.sparkContext.broadcast(made)


def _windows(window: int, shingle: int):
    """Item rows (key, text) → one row per window: its words and, per distinct shingle, hash and places in the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_key", pa.int64()), ("words", pa.string()), ("len", pa.int32()), ("width", pa.int32()),
                            ("shingles", pa.list_(pa.int64()))])
        for b in batches:
            for key, data in zip(b.column(0).to_pylist(), texts(b.column(1))):
                h, s, e = words_of_bytes(data)
                size = min(window, len(h))
                if not size:
                    continue
                width = min(shingle, size)
                hashes = shingle_hashes(h, width).view(np.int64)
                for lo in range(0, len(h) - size + 1, 1024):  # a long item gives its windows in batches
                    at = range(lo, min(lo + 1024, len(h) - size + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(at), pa.int64()), pa.array([words_text(data, s, e, i, i + size) for i in at], pa.string()),
                         pa.array([size] * len(at), pa.int32()), pa.array([width] * len(at), pa.int32()),
                         pa.array([hashes[i:i + size - width + 1].tolist() for i in at], pa.list_(pa.int64()))], schema=schema)
    return run


def _counts(widths: list[int], shared):
    """Documents → (shingle, times) of the shingles that pass the filter, counted per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep: ShingleFilter = shared.value
        for b in batches:
            found, waiting = [], 0
            for data in texts(b.column(0)):
                h, _, _ = words_of_bytes(data)
                for width in widths:
                    s = shingle_hashes(h, width)
                    found.append(s[keep.find(s)])
                    waiting += len(found[-1])
                if waiting > 1 << 20:
                    yield _counted(found)
                    found, waiting = [], 0
            yield _counted(found)
    return run


def _counted(found: list[np.ndarray]) -> pa.RecordBatch:
    values, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(times.astype(np.int64))], names=["shingle", "times"])


_FOUND = pa.list_(pa.struct([("shingle", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("around", pa.string())]))
_FOUND_SQL = "array<struct<shingle:long, pos:int, first:int, around:string>>"


def _scan(widths: list[int], window: int, shingle: int, shared):
    """Documents (_text, other columns) → those columns, word count and the places of prefix shingles.

    ``around`` is the words from ``first`` on that any window over the place can need, so no later step needs the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep: ShingleFilter = shared.value

        def out(b: pa.RecordBatch, lo: int, counts: list, lists: list) -> pa.RecordBatch:
            part = b.slice(lo, len(counts))
            names = [n for n in part.schema.names if n != "_text"]
            columns = [part.column(part.schema.names.index(n)) for n in names]
            return pa.RecordBatch.from_arrays(columns + [pa.array(counts, pa.int64()), pa.array(lists, _FOUND)],
                                              names=names + ["n_words", "found"])

        for b in batches:
            lo, counts, lists, waiting = 0, [], [], 0
            for data in texts(b.column(b.schema.names.index("_text"))):
                h, s, e = words_of_bytes(data)
                found = []
                for width in widths:
                    hashes = shingle_hashes(h, width)
                    at = keep.find(hashes)
                    span = window if width == shingle else width  # shorter shingles stand for windows of their own size
                    for p, v in zip(at.tolist(), hashes[at].view(np.int64).tolist()):
                        first = max(0, p + width - span)
                        found.append({"shingle": v, "pos": p, "first": first, "around": words_text(data, s, e, first, min(len(h), p + span))})
                counts.append(len(h))
                lists.append(found)
                waiting += 1 + len(found)
                if waiting > 20000:
                    yield out(b, lo, counts, lists)
                    lo, counts, lists, waiting = lo + len(counts), [], [], 0
            yield out(b, lo, counts, lists)
    return run


def merge_ranges(starts, ends) -> list[dict]:
    """Word ranges of one document in the order of their starts → the fewest ranges that cover the same words."""
    a, b = np.asarray(starts, np.int64), np.maximum.accumulate(np.asarray(ends, np.int64))
    cut = np.flatnonzero(a[1:] > b[:-1]) + 1
    return [{"start": int(x), "end": int(y)} for x, y in zip(a[np.append(0, cut)], b[np.append(cut - 1, len(b) - 1)])]


def _merged(starts, ends):
    @F.pandas_udf("array<struct<start: int, end: int>>")
    def merged(starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([merge_ranges(a, b) for a, b in zip(starts, ends)])

    return merged(starts, ends)


SALTS = 64


def _candidate_pairs(found: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Places joined with the windows that have the shingle in their prefix.

    A shingle with more than a thousandth of all places is hot; there are fewer than 1,000 such. Its places are dealt
    over ``SALTS`` groups and its windows copied to each, so that a passage in a third of all documents is no one task.
    """
    sizes = checkpointed(found.groupBy("shingle").agg(F.count("*").alias("rows")))
    n = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = sizes.filter(F.col("rows") > max(n // 1000, 1000)).select("shingle", F.lit(True).alias("_hot"))
    flag = lambda df: df.join(F.broadcast(hot), "shingle", "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    rows = flag(found).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("_key", "pos"), F.lit(SALTS))).otherwise(0))
    windows = flag(prefixes).withColumn("_salt", F.explode(
        F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")))
    return rows.drop("_hot").join(windows.drop("_hot"), ["shingle", "_salt"])


def _rare_prefixes(windows: DataFrame, counts: DataFrame, containment: float) -> DataFrame:
    """Rows (wid, shingle, off, need): per window its n - need + 1 rarest shingles, ``need`` = ceil(containment n).

    Rarity is the number of places in all documents, ties by hash. A window of whose shingles fewer than ``need`` occur
    in any document cannot be contained in one and is left out.
    """
    from pyspark.sql import Window

    each = windows.select("wid", F.posexplode("shingles").alias("off", "shingle")).groupBy("wid", "shingle").agg(F.min("off").alias("off"))
    uses = each.groupBy("shingle").agg(F.count("*").alias("rows"))
    known = checkpointed(counts.join(uses, "shingle"))
    in_window = Window.partitionBy("wid")  # at most as many rows as a window has words
    n_all = each.groupBy("wid").agg(F.count("*").alias("n"))
    rows = attach(each, known, "shingle", "rows", each.count()).join(n_all, "wid")
    need = F.ceil(F.col("n") * containment - 1e-9).cast("int")
    ranked = rows.withColumn("need", F.greatest(need, F.lit(1))).withColumn("_present", F.count("*").over(in_window))
    ranked = ranked.filter("_present >= need").withColumn("_rank", F.row_number().over(in_window.orderBy("times", "shingle")))
    # the absent shingles are the rarest of all and take the first places of the prefix
    return ranked.filter(F.col("_rank") <= F.col("n") - F.col("need") + 1 - (F.col("n") - F.col("_present"))).select("wid", "shingle", "off", "need")


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = 10, shingle: int = 3, containment: float = 1.0,
                 max_log_bits: int = 30) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``spans`` (start, end in words, merged) and ``items`` (sorted ids).

    Words are runs outside \\x00-\\x2F, \\x3A-\\x60 and \\x7B-\\x7F of the text with A-Z lower-cased. A span is where windows
    of items stand: runs of ``window`` words of an item, or a whole item of fewer. At ``containment`` 1 the window's
    words must stand there in order; below, a stretch of the window's size must hold that share of the window's distinct
    shingles of ``shingle`` words. Nulls and texts without words have no words, so no spans, and as items no windows; an
    item with a null id marks words but is not listed; rows that repeat an id count as one item. Repeated documents
    appear once each. Texts are read whole in pieces of bounded size. An empty ``docs`` gives an empty result, an empty
    ``bench`` no span anywhere. Other columns are not read, whatever their names. An item id is listed as text.
    """
    if not 0 < containment <= 1:
        raise ValueError("containment must be above 0 and at most 1")
    texts_of = docs.select(F.col(q(id_col)).alias("_id"), F.col(q(text_col)).cast("string").alias("_text"))
    items = checkpointed(bench.select(F.col(q(item_col)).cast("string").alias("item"), F.col(q(item_text_col)).cast("string").alias("_text"))
                         .distinct().withColumn("item_key", F.monotonically_increasing_id()))
    cut = items.select("item_key", "_text").mapInArrow(
        _windows(window, shingle), "item_key long, words string, len int, width int, shingles array<long>")
    # one row per different window, with the ids that hold it: each document that has the window must list them all
    windows = checkpointed(cut.join(items.select("item_key", "item"), "item_key").groupBy("words").agg(
        F.first("len").alias("len"), F.first("width").alias("width"), F.first("shingles").alias("shingles"),
        F.collect_set("item").alias("items")).withColumn("wid", F.monotonically_increasing_id()))
    widths = sorted(r.width for r in windows.select("width").distinct().collect())  # at most ``shingle`` values
    every = shingle_filter(windows.select(F.explode("shingles").alias("shingle")).distinct(), max_log_bits)
    counts = texts_of.select("_text").mapInArrow(_counts(widths, every), "shingle long, times long").groupBy("shingle").agg(
        F.sum("times").alias("times"))
    prefixes = checkpointed(_rare_prefixes(windows, counts, containment).join(windows, "wid"))
    rare = shingle_filter(prefixes.select("shingle").distinct(), max_log_bits)
    rows = texts_of.withColumn("_key", F.monotonically_increasing_id())
    schema = StructType([rows.schema["_id"], rows.schema["_key"], StructField("n_words", LongType()),
                         StructField("found", StructType.fromDDL(f"f {_FOUND_SQL}")["f"].dataType)])
    scanned = checkpointed(rows.select("_id", "_key", "_text").mapInArrow(_scan(widths, window, shingle, rare), schema))
    found = scanned.select("_key", "n_words", F.explode("found").alias("f")).select("_key", "n_words", "f.*")
    pairs = _candidate_pairs(found, prefixes.withColumnRenamed("off", "at"))
    around = F.split("around", " ", -1)
    if containment == 1.0:
        pairs = pairs.withColumn("start", F.col("pos") - F.col("at"))
    else:  # the stretch may begin wherever it still holds the place
        pairs = pairs.withColumn("start", F.explode(F.sequence(
            F.greatest(F.lit(0), F.col("pos") + F.col("width") - F.col("len")), F.col("pos"))))
    pairs = pairs.filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    stretch = F.slice(around, F.greatest(F.lit(1), F.col("start") - F.col("first") + 1), F.col("len"))
    if containment == 1.0:
        hits = pairs.filter(F.array_join(stretch, " ") == F.col("words"))
    else:
        grams = lambda ws: F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.col("len") - F.col("width") + 1), lambda i: F.array_join(F.slice(ws, i, F.col("width")), " ")))
        hits = pairs.filter(F.size(F.array_intersect(grams(stretch), grams(F.split("words", " ", -1)))) >= F.col("need"))
    ranges = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))))
    per_doc = hits.groupBy("_key").agg(ranges.alias("r"), F.collect_set("items").alias("i"))
    per_doc = per_doc.select("_key", _merged(F.col("r.start"), F.col("r.end")).alias("spans"),
                             F.array_sort(F.array_distinct(F.flatten("i"))).alias("items"))
    none = F.array().cast("array<struct<start:int, end:int>>")
    return scanned.select("_id", "_key", "n_words").join(per_doc, "_key", "left").select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op11_prefix_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT item, l, array_to_string(w[p:p + l - 1], ' ') AS s FROM (
    SELECT item, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
win AS MATERIALIZED (SELECT DISTINCT item, l, s FROM bw),
lens AS (SELECT DISTINCT l FROM win),
dw AS (
  SELECT k, l, p, array_to_string(w[p:p + l - 1], ' ') AS s FROM (
    SELECT k, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, lens WHERE len(w) >= l)),
hit AS MATERIALIZED (SELECT dw.k, dw.p, win.l, win.item FROM dw JOIN win USING (l, s)),
n AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(p, p + l)) AS p FROM (SELECT DISTINCT k, p, l FROM hit)) GROUP BY k),
i AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT k, item FROM hit WHERE item IS NOT NULL) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (k) LEFT JOIN i USING (k)
"""
