"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources share the mix by weight, up to a cap on repetition; what a capped source cannot take is shared again.
Seats: a source is cut into blocks of equally many words, ``block_words`` or a 16th of its words or target if that is
less. Sainte-Lague gives the sources their numbers of blocks (each next block goes to the highest quotient of target, in
the source's blocks, by 2 seats + 1), and each source's blocks go to its shards the same way.
Blocks: inside a shard documents lie one after another in a seeded order, cut into equal blocks; a seeded phase decides
which blocks are taken and which are taken once more, so that the shard's quota is met exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import HOT_SHARE, WORD, attach, checkpointed, numbered, packed, q, read, text_or_empty, unpacked

GRID = 32  # divisors tried in one round of the search
LEAST_BLOCKS = 16  # a source's words and its target make at least so many blocks, as far as a block has a word
WEIGHTS = (3, 1, 2)


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_key(source: str) -> Column:
    """A key that is never null: sorts by code point, null last."""
    c = F.col(q(source))
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), c.cast("string")))


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(key, size, ...) → adds ``target``: share * total by weight, at most cap * size, the excess shared again."""
    table = numbered(sizes, F.col("key"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_no") % len(weights) + 1).cast("int"))
    table = checkpointed(table.withColumn("weight", weight).drop("_no"))
    total = share * float(table.agg(F.sum("size")).first()[0] or 0)
    level, before = 0.0, None
    while True:  # each round caps at least one more source or ends
        capped = F.lit(level) * F.col("weight") > F.lit(cap) * F.col("size")
        gone, free = table.agg(F.sum(F.when(capped, F.lit(cap) * F.col("size")).otherwise(0.0)),
                               F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not free or (gone, free) == before:
            break
        before, level = (gone, free), (total - gone) / free
    return table.withColumn("target", F.least(F.lit(cap) * F.col("size"), F.lit(level) * F.col("weight"))).drop("weight")


def _seats_at(divisor: Column) -> Column:
    return F.floor(F.col("value") / divisor + 0.5)


def sainte_lague(parties: DataFrame, seats: DataFrame) -> DataFrame:
    """Apportion ``seats`` (grp, seats) among ``parties`` (grp, name, value); adds ``won``. Ties go to the smaller name.

    The highest-quotient rule gives party v exactly floor(v / d + 1/2) seats for a common divisor d. For all groups at
    once, a grid search narrows each group's d until its seats add up; only when equal quotients leave no such d are
    the last seats given one by one to the highest quotients. Values of zero win nothing.
    """
    parties = checkpointed(parties)
    state = parties.groupBy("grp").agg(F.sum("value").alias("v"), F.count("*").alias("n")).join(seats, "grp")
    half = F.col("n") / 2.0 + 1.0
    state = state.select(
        "grp", "seats", (F.col("v") / (F.col("seats") + half)).alias("lo"),
        F.when(F.col("seats") > half, F.col("v") / (F.col("seats") - half)).otherwise(F.col("v") * 4.0).alias("hi"),
        (F.col("v") <= 0).alias("done"))
    state = checkpointed(state.withColumn("hi", F.when(F.col("done"), 1.0).otherwise(F.col("hi"))))
    point = lambda j: F.col("lo") + (F.col("hi") - F.col("lo")) * (j / GRID)
    while state.filter("not done").limit(1).count():
        sums = parties.join(state.filter("not done"), "grp").groupBy("grp", "seats", "lo", "hi").agg(
            *[F.sum(_seats_at(point(j))).alias(f"s{j}") for j in range(1, GRID)])
        lo, hi, at = F.col("lo"), F.col("hi"), F.lit(None).cast("long")
        for j in range(GRID - 1, 0, -1):  # the smallest divisor whose seats are not too many
            fits = F.col(f"s{j}") <= F.col("seats")
            hi = F.when(fits, point(j)).otherwise(hi)
            at = F.when(fits, F.col(f"s{j}")).otherwise(at)
        for j in range(1, GRID):  # and the largest one whose seats are too many
            lo = F.when(F.col(f"s{j}") > F.col("seats"), point(j)).otherwise(lo)
        step = sums.select("grp", "seats", lo.alias("lo"), hi.alias("hi"),
                           F.coalesce(at == F.col("seats"), F.lit(False)).alias("met"))
        step = step.withColumn("done", F.col("met") | ((F.col("hi") - F.col("lo")) <= F.col("hi") * 1e-15)).drop("met")
        state = checkpointed(state.filter("done").unionByName(step))
    base = parties.join(state, "grp").withColumn("base", F.when(F.col("value") > 0, _seats_at(F.col("hi"))).otherwise(0))
    left = base.groupBy("grp").agg((F.max("seats") - F.sum("base")).alias("left")).filter("left > 0")
    tied = base.filter((F.col("value") > 0) & (F.col("lo") > 0)).filter(_seats_at(F.col("lo")) > F.col("base")).join(left, "grp")
    quotient = F.col("value") / (2 * F.col("base") + 1)
    extra = tied.withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(quotient.desc(), "name")))
    extra = extra.filter("r <= left").select("grp", "name", F.lit(1).alias("one"))
    won = base.join(extra, ["grp", "name"], "left")
    return won.select("grp", "name", "value", (F.col("base") + F.coalesce("one", F.lit(0))).cast("long").alias("won"))


def _hash(seed: int, what: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|{what}|"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))


def _number(hash_hex: Column) -> Column:
    return F.conv(F.substring(hash_hex, 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
        cap: float = 2.0, weights=WEIGHTS, block_words: int = 32, shard_words: int = 1 << 20, seed: int = 42) -> DataFrame:
    """(row, id, size, source_size, target, taken, spans) of every row of ``docs``.

    ``size`` counts the words (runs without white space; null and empty: 0), ``source_size`` those of the row's source,
    ``target`` is the source's share of the mix. ``taken`` is how many words of the row the mix holds, repeats counted:
    at most ``cap`` (rounded up) times its size. ``spans`` lists (first word, end word, times) of its blocks. ``row`` is
    the row's number in the scan, to find it again. A null source is a source of its own, after all others. Repeated
    rows are separate rows. Rows without words get 0 and no span. An empty table gives an empty result.

    A block of a source holds about min(``block_words``, words / 16, target / 16) words, at least one, by the same rule
    at every size; so a source of any size comes within half a block of its target (with several shards, which are cut
    separately, within a few words more). The mix as a whole is off by no more than the sources' sum of that.

    A source has one shard per ``shard_words`` words, and rows without words stand in no window, so a window over a shard
    is bounded however large the source is. Rows are dealt to shards by id; those of an id (or of none) with over a
    thousandth of all rows by row number too. Input columns that are not named are not read, whatever their names; a very
    long text is one row of a window, which holds its size and not the text.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(q(id_col)).alias("id"),
                       source_key(source_col).alias("key"), word_count(text_col).alias("size"))
    rows = checkpointed(rows)
    n = rows.count()
    sizes = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    sources = targets(sizes, share, cap, weights).withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("size") / shard_words)).cast("long"))
    block = F.floor(F.least(F.col("size").cast("double"), F.col("target")) / LEAST_BLOCKS)
    sources = checkpointed(sources.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), block)).cast("long")))

    placed = attach(rows, sources.withColumnRenamed("size", "source_size"), "key", "rows", n)
    often = rows.groupBy("id").agg(F.count("*").alias("rows")).filter(F.col("rows") > max(n // HOT_SHARE, 4096)).select(
        F.col("id").alias("_often"))  # fewer than HOT_SHARE ids
    often = often.withColumn("_hot", F.lit(True))
    placed = placed.join(F.broadcast(often), F.col("id").eqNullSafe(F.col("_often")), "left")
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64("row"), F.col("shards"))).otherwise(0)
    placed = placed.withColumn("shard", F.pmod(_number(_hash(seed, "shard")) + spread, F.col("shards"))).drop("_often", "_hot")
    shards = placed.filter("size > 0").groupBy("key", "shard").agg(F.sum("size").alias("words"), F.max("block").alias("block"))
    shards = checkpointed(shards.withColumn("n", F.ceil(F.col("words") / F.col("block")).cast("long")))
    blocks = shards.groupBy("key").agg(F.sum("n").alias("n"))
    values = checkpointed(sources.join(blocks, "key").select(
        F.lit(0).alias("grp"), F.col("key").alias("name"), (F.col("target") * F.col("n") / F.col("size")).alias("value")))
    seats = values.groupBy("grp").agg(F.sum(F.floor(F.col("value") + 0.5)).cast("long").alias("seats"))
    won = sainte_lague(values, seats)
    won = checkpointed(won.select(F.col("name").alias("grp"), F.col("won").alias("seats")))
    quotas = sainte_lague(shards.select(F.col("key").alias("grp"), F.col("shard").alias("name"), F.col("n").cast("double").alias("value")), won)
    quotas = quotas.select(F.col("grp").alias("key"), F.col("name").alias("shard"), "won").join(shards.drop("block"), ["key", "shard"])
    quotas = quotas.withColumn("quota", F.least(F.col("won"), (F.lit(cap) * F.col("n")).cast("long"))).drop("won")
    phase = F.pmod(_number(F.md5(F.concat_ws("|", F.lit(f"{seed}|phase"), "key", F.col("shard").cast("string")).cast("binary"))), F.col("n"))
    quotas = checkpointed(quotas.withColumn("phase", phase))

    order = Window.partitionBy("key", "shard").orderBy(_hash(seed, "order"), "id", "size", "row")
    laid = placed.filter("size > 0").withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.withColumn("start", F.col("end") - F.col("size")).join(quotas, ["key", "shard"])
    spans = """transform(sequence(((start + 1) * n - 1) div words, (end * n - 1) div words), j -> struct(
                 greatest(start, j * words div n) - start as first,
                 least(end, (j + 1) * words div n) - start as until,
                 ((j + 1 + phase) * quota) div n - ((j + phase) * quota) div n as times))"""
    empty = "cast(array() as array<struct<first: bigint, until: bigint, times: bigint>>)"
    laid = laid.withColumn("spans", F.expr(spans)).unionByName(placed.filter("size = 0").withColumn("spans", F.expr(empty)), True)
    taken = F.expr("aggregate(spans, cast(0 as bigint), (sum, s) -> sum + (s.until - s.first) * s.times)")
    return laid.select("row", "id", "size", "source_size", "target", taken.alias("taken"), "spans")


def copies(text: str, size: int, spans: list[tuple[int, int, int]]) -> list[str]:
    """The texts that a row adds to the mix: its words taken once or more, those taken twice or more, and so on."""
    out, bounds = [], None
    for times in range(1, max((s[2] for s in spans), default=0) + 1):
        ranges: list[list[int]] = []
        for first, until, t in spans:
            if t >= times and until > first:
                if ranges and ranges[-1][1] == first:
                    ranges[-1][1] = until
                else:
                    ranges.append([first, until])
        if ranges == [[0, size]]:
            out.append(text)
        elif ranges:
            bounds = bounds or [m.span() for m in re.finditer(WORD, text)]
            out.append("\n".join(text[bounds[a][0]:bounds[b - 1][1]] for a, b in ranges))
    return out


def _copies_column():
    @F.pandas_udf("array<string>")
    def f(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, size, spans in parts:
            yield pd.Series([copies(t, n, [(s["first"], s["until"], s["times"]) for s in ss])
                             for t, n, ss in zip(text, size, spans)], dtype=object)

    return f


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          length_col: str = "n_chars", **how) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each copy, with the words taken; columns are those of ``docs``.

    A row taken whole keeps its text unchanged; a cut text keeps its words and their spacing inside each span and joins
    spans by a line break. ``length_col``, if there, becomes the new text's length. ``docs`` is scanned twice and must
    give the same rows in the same partitions, as a table scan or a checkpoint does.
    """
    plan = mix(docs, id_col, text_col, source_col, **how).filter("taken > 0").select("row", "size", "spans")
    rows = docs.select(packed(docs).alias("_row"), F.monotonically_increasing_id().alias("row"))
    texts = rows.join(plan, "row").select("_row", F.explode(_copies_column()(
        F.col("_row").getField(text_col), F.col("size"), F.col("spans"))).alias("_text"))
    new = {text_col: F.col("_text")}
    if length_col in docs.columns:
        new[length_col] = F.length("_text").cast(docs.schema[length_col].dataType)
    return texts.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op4_mix_sainte_lague(spark, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


# The same result by the highest quotients themselves: every quotient is listed and the largest ones win.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 'a' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT k, sum(size)::BIGINT AS ss, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::INTEGER]::DOUBLE AS w
      FROM d GROUP BY k),
c AS (  -- sources by the level at which they are capped: all before the first that holds out are capped
  SELECT *, 2.0::DOUBLE * ss / w AS stop,
         1.5::DOUBLE * (SELECT sum(ss) FROM s)::DOUBLE - coalesce(sum(2.0::DOUBLE * ss) OVER b, 0.0) AS rest,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER b, 0.0) AS free
  FROM s WINDOW b AS (ORDER BY 2.0::DOUBLE * ss / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest / free, stop) AS level FROM c WHERE stop >= rest / free),
t AS (SELECT *, greatest(1, least(32, floor(least(ss::DOUBLE, target) / 16)))::BIGINT AS b FROM (
        SELECT k, ss, least(2.0::DOUBLE * ss, l.level * w) AS target, greatest(1, ceil(ss / 1048576.0))::BIGINT AS shards FROM s, l)),
p AS (SELECT d.*, t.ss, t.target, t.b, ('0x' || substr(md5('42|shard|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % t.shards AS shard,
             md5('42|order|' || coalesce(doc_id::VARCHAR, '')) AS o FROM d JOIN t USING (k)),
sh AS (SELECT k, shard, sum(size)::BIGINT AS words, ceil(sum(size) / max(b)::DOUBLE)::BIGINT AS n FROM p WHERE size > 0 GROUP BY k, shard),
v AS (SELECT k, target * n / ss AS v FROM t JOIN (SELECT k, sum(n)::BIGINT AS n FROM sh GROUP BY k) USING (k)),
quot AS (SELECT k, v / (2 * i.i + 1) AS x FROM v, LATERAL (SELECT unnest(range(0, v.v::BIGINT + 50)) AS i) i),
won AS (SELECT k, count(*) AS won FROM (
          SELECT k FROM quot WHERE x > 0 ORDER BY x DESC, k LIMIT (SELECT sum(floor(v + 0.5))::BIGINT FROM v)) GROUP BY k),
q2 AS (SELECT k, shard, n / (2 * i.i + 1)::DOUBLE AS x FROM sh, LATERAL (SELECT unnest(range(0, 2 * n + 50)) AS i) i),
qr AS (SELECT k, shard, row_number() OVER (PARTITION BY k ORDER BY x DESC, shard) AS r FROM q2 WHERE x > 0),
sq AS (SELECT k, shard, count(*) AS won FROM qr JOIN won USING (k) WHERE r <= won.won GROUP BY k, shard),
qt AS (
  SELECT k, shard, words, n, least(coalesce(won, 0), 2 * n) AS quota,
         ('0x' || substr(md5('42|phase|' || k || '|' || shard::VARCHAR), 1, 8))::BIGINT % n AS phase
  FROM sh LEFT JOIN sq USING (k, shard)),
laid AS (
  SELECT p.doc_id, p.size, p.ss, p.target, words, n, quota, phase,
         (sum(size) OVER (PARTITION BY k, shard ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS e  -- size 0 adds nothing
  FROM p LEFT JOIN qt USING (k, shard))
SELECT doc_id, size, ss AS source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE list_sum(list_transform(
         range(((e - size + 1) * n - 1) // words, (e * n - 1) // words + 1), lambda j:
           (least(e, (j + 1) * words // n) - greatest(e - size, j * words // n))
           * (((j + 1 + phase) * quota) // n - ((j + phase) * quota) // n))) END::BIGINT AS taken
FROM laid
"""
