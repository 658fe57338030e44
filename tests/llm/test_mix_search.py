"""Mixing, apportionment, top-k search, the queries' SQL and the pipeline, with odd cases."""

import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from tabsmith.llm import mixing, topk
from tabsmith.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=str) == sorted(rel.fetchall(), key=str)


def test_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in QUERIES) == list(range(1, 14))


def _highest_quotients(values, seats):
    """Brute force: one seat after another."""
    won = {k: 0 for k in values}
    for _ in range(seats):
        live = [k for k in values if values[k] > 0]
        if not live:
            break
        k = min(live, key=lambda k: (-values[k] / (2 * won[k] + 1), k))
        won[k] += 1
    return won


@pytest.mark.parametrize("values, seats", [
    ({"a": 53.0, "b": 24.0, "c": 23.0}, 7), ({"a": 10.0, "b": 10.0, "c": 10.0}, 5), ({"a": 1.0, "b": 0.0}, 4), ({"a": 5.0}, 0),
    ({"a": 1e9, "b": 1.0, "c": 3.0}, 1000), ({f"p{i}": float(i * i % 17 + 1) for i in range(30)}, 211), ({"a": 0.0}, 3)])
def test_sainte_lague(spark, values, seats):
    parties = spark.createDataFrame([(0, k, v) for k, v in values.items()] + [(1, k, v) for k, v in values.items()],
                                    "grp int, name string, value double")
    want = spark.createDataFrame([(0, seats), (1, seats + 2)], "grp int, seats long")
    got = {(r.grp, r.name): r.won for r in mixing.sainte_lague(parties, want).collect()}
    for g, n in ((0, seats), (1, seats + 2)):
        assert {k: got[g, k] for k in values} == _highest_quotients(values, n)


def _mix_rows():
    rows = [(i, "word " * (i % 37 + 1), "en", f"s{i % 3}") for i in range(300)]
    rows += [(400 + i, "lone " * 20, "en", "tiny") for i in range(2)] + [(500, None, "en", None), (501, "a b c", "en", None)]
    return rows + [(502, "", "en", "void"), (7, "word " * 8, "en", "s1"), (7, "word " * 8, "en", "s1"), (None, "x y " * 50, "en", "s2")]


def test_mix(docs_of):
    rows = _mix_rows()
    how = {"block_words": 4, "shard_words": 800}
    docs = docs_of(rows, extra=["key", "shard", "taken"])
    got = mixing.mix(docs, **how).collect()
    assert len(got) == len(rows)
    sizes, want, taken = {}, {}, {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    left, total = dict(zip(order, [(3, 1, 2)[i % 3] for i in range(len(order))])), 1.5 * sum(sizes.values())
    while True:  # share by weight, cap, share the rest again
        level = (total - sum(want.values())) / sum(left.values())
        over = [s for s in left if level * left[s] > 2 * sizes[s]]
        if not over:
            want |= {s: level * w for s, w in left.items()}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            del left[s]
    by_size = {}
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == sum((s.until - s.first) * s.times for s in r.spans)
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    assert {(sizes[s], round(want[s], 6)) for s in sizes} == set(by_size)
    for (size, target), t in by_size.items():
        assert abs(sum(t) - target) <= max(0.03 * target, 12)
    again = mixing.mix(docs.repartition(7), **how).collect()
    key = lambda r: (str(r.id), r.size, r.source_size, r.target, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents(docs_of):
    docs = docs_of(_mix_rows(), extra=["row", "_text"])
    how = {"block_words": 4, "shard_words": 800}
    out = mixing.mixed(docs, **how)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(r.text.split()) for r in rows) == mixing.mix(docs, **how).agg(F.sum("taken")).first()[0]
    assert all(r.n_chars == len(r.text) for r in rows) and {r["_text"] for r in rows} == {"mine"}
    whole = {t for _, t, *_ in _mix_rows()}
    assert sum(r.text in whole for r in rows) > len(rows) / 2


def _small_rows(sizes):
    """Sources of so many words, in texts of up to 9."""
    rows = []
    for s, n in sizes.items():
        rows += [(len(rows) + at // 9, " ".join(f"{s}{i}" for i in range(at, min(n, at + 9))), "en", s) for at in range(0, n, 9)]
    return rows


@pytest.mark.parametrize("sizes, want", [
    ({"a": 7, "b": 20, "c": 50, "d": 3000}, {"a": 14, "b": 40, "c": 100}),
    ({"a": 100, "b": 100, "c": 100}, {"a": 200, "b": 250 / 3, "c": 500 / 3}),
    ({"a": 7, "b": 7, "c": 7, "d": 5000}, {"a": 14, "b": 14, "c": 14}),
    ({"a": 1, "b": 0, "c": 4000}, {"a": 2, "b": 0})])
def test_small_sources_come_near_their_targets(spark, docs_of, sizes, want):
    docs = docs_of(_small_rows(sizes))
    rows = mixing.mix(docs, ).collect()
    assert all(r.taken <= 2 * r.size and r.taken == sum((s.until - s.first) * s.times for s in r.spans) for r in rows)
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, targets = dict.fromkeys(sizes, 0), {}
    for r in rows:
        taken[source[r.id]] += r.taken
        targets[source[r.id]] = r.target
    for s, t in want.items():
        assert abs(targets.get(s, 0) - t) < 1e-6 and abs(taken[s] - t) <= max(1, min(32, sizes[s] / 16, t / 16)) / 2 + 0.5  # half a block, and rounding to words
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 32 * len(sizes)
    staged = dict.fromkeys(sizes, 0)  # the pipeline's stage takes the same words
    for r in corpus_pipeline.mix(spark, docs, "").collect():
        staged[r.source] += len(r.text.split())
    assert staged == taken


def test_empty_and_repeated_rows_do_not_meet_in_one_window(docs_of):
    rows = [(i, "", "en", "void") for i in range(6000)] + [(None, "a b c", "en", "s") for _ in range(6000)] + [(1, "x " * 9, "en", "s")]
    got = mixing.mix(docs_of(rows), shard_words=1000).collect()
    assert len(got) == len(rows) and all(r.taken == 0 and not r.spans for r in got if not r.size)
    assert max(r.taken for r in got if r.size) <= 18
    total = sum(r.taken for r in got)
    target = next(r.target for r in got if r.size)
    assert abs(total - target) <= 0.02 * target


def test_copies():
    assert mixing.copies("a b  c d", 4, [(0, 2, 1), (2, 4, 1)]) == ["a b  c d"]
    assert mixing.copies("a b  c d", 4, [(0, 2, 2), (2, 4, 1)]) == ["a b  c d", "a b"]
    assert mixing.copies("a b  c d", 4, [(0, 1, 1), (1, 3, 0), (3, 4, 1)]) == ["a\nd"]
    assert mixing.copies("", 0, []) == []


@pytest.mark.parametrize("f", [mixing.mix, mixing.mixed])
def test_mix_empty_tables(docs_of, f):
    assert f(docs_of([])).collect() == []
    assert [r.taken for r in mixing.mix(docs_of([(1, None), (2, " ")])).collect()] == [0, 0]


def _brute_top(rows, k):
    use = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            use.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for n, (i, v) in enumerate(use):
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(use) if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("k, segments", [(1, 1), (5, 4), (20, 4), (200, 3)])
def test_top_k_matches_brute_force(spark, k, segments):
    rnd = np.random.default_rng(k)
    rows = [(int(i), [float(x) for x in rnd.normal(0, 0.3, 12)]) for i in range(150)]
    same = [0.25] * 12
    rows += [(200 + i, same) for i in range(60)]  # ties of one hot vector
    rows += [(20, rows[20][1]), (300, None), (301, [None] * 12), (320, [float("nan")] * 12), (340, [float("inf")] * 12), (None, same),
             (360, []), (380, [1.0]), (381, [5000.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit("mine")).repartition(3)
    got = topk.top_k(df, F.col("id") % 20 == 0, k=k, segments=segments, query_block=4, candidate_block=32).collect()
    assert sorted(map(tuple, got)) == _brute_top(rows, k)


def test_top_k_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("id") % 20 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), F.col("id") % 20 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], schema), F.col("id") % 20 == 0).collect() == []


def test_top_k_large_numbers_stay_exact(spark):
    rows = [(20, [3e7, 1.0]), (21, [3e7, 1.0]), (22, [3e7, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df, F.col("id") % 20 == 0).collect())) == _brute_top(rows, 20)


def test_pipeline(spark, docs_of, cases, tmp_path):
    labels = [(i, 1, int(i % 3 == 0)) for i in range(1000, 1120)]
    rows = [(i, f"some plain text number {i} about rivers and {'scum idiot' if y else 'gardens'}", "en", f"s{i % 4}") for i, _, y in labels]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs_of(rows + [(i, t, "en", "s1") for i, t in cases]).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    first = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{n}")
        docs = spark.read.parquet(f"{tmp_path}/out{n}")
        seen.append(docs)
        assert n == len(corpus_pipeline.STAGES) - 1 or docs.columns == first
    kept = {r.text for r in seen[0].collect()}
    assert not any("scum" in (t or "") for t in kept) and sum("gardens" in (t or "") for t in kept) == 80
    assert {None, "", "  \t\n", "12345 !!! 678"} <= kept
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in seen[1].collect()]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in kept})
    assert {r.text for r in seen[2].collect()} <= {r.text for r in seen[1].collect()}
    assert all(r.round_trip for r in docs.collect()) and docs.count() == seen[3].count()


def test_pipeline_of_an_empty_table(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
