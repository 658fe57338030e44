"""Exact dedup and SimHash classes against brute force, and the odd cases of both."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tabsmith.llm import exact_dedup as ed
from tabsmith.llm import simhash as sh
from tabsmith.llm.graph import connected_components


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def _brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, first, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def test_exact_dedup_odd_cases(docs_of, cases):
    df = docs_of(cases, extra=["kept", "_sha", "cell", "_maybe"])
    out = ed.exact_dedup(df)
    rows = out.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == _brute(cases)
    assert sum(r.kept for r in rows) == len({_norm(t) for _, t in cases})
    assert {r["_sha"] for r in rows} == {"mine"} and {r["cell"] for r in rows} == {"mine"}
    assert out.columns.count("kept") == 1


def test_full_filter_changes_nothing(docs_of):
    # a filter of one bitmap for many rows lets some unrepeated rows through to the shuffle; results stay
    rows = [(i, f"text {i % 700}") for i in range(1500)]
    out = ed.exact_dedup(docs_of(rows), max_filter_bits=ed.BITMAP_BITS, bits_per_row=1, n_hash=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str) == _brute(rows)


def test_probe_finds_every_repeated_hash(spark):
    rows = spark.range(4000).select((F.col("id") % 3500).cast("string").alias("_sha"))
    bits = ed.filter_bits(4000, 8, 1 << 28)
    cells = ed.repeated_cells(rows, "_sha", bits, 2)
    got = ed.probe(rows, "_sha", cells, bits, 2).groupBy("_sha").agg(F.count("*").alias("n"), F.min("_maybe").alias("m")).collect()
    assert all(r.m for r in got if r.n > 1)
    assert sum(r.m for r in got if r.n == 1) < 0.25 * sum(r.n == 1 for r in got)


def test_native_plan(docs_of, cases):
    plan = ed.exact_dedup(docs_of(cases))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("f", [ed.exact_dedup, ed.keep_first, sh.simhash_classes, sh.keep_one_per_class])
def test_empty_table(docs_of, f):
    assert f(docs_of([])).collect() == []


def test_keep_first(docs_of, cases):
    df = docs_of(cases, extra=["keep_id"])
    out = ed.keep_first(df)
    assert out.columns == df.columns
    assert sorted(_norm(r.text) for r in out.collect()) == sorted({_norm(t) for _, t in cases})


def _fingerprint(text, n=3):
    from xxhash import xxh64_intdigest

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def _classes(prints, bits):
    """Brute force: union-find over all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_simhash_matches_brute_force(docs_of, cases):
    rows = cases + [(100 + i, " ".join(f"w{j}" for j in range(40)) + f" end{i % 7}") for i in range(60)]
    got = sh.simhash_classes(docs_of(rows, extra=["fp", "fingerprint", "root"])).collect()
    prints = [_fingerprint(t) for _, t in rows]
    roots = _classes(prints, 2)
    low = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in roots}
    want = sorted((str(i), f"{p:016x}", str(low[r])) for (i, _), p, r in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("bucket_rows", [2, 64])
def test_links_keep_every_connection(spark, max_bits, bucket_rows):
    import random

    rnd = random.Random(max_bits)
    base = [rnd.getrandbits(64) for _ in range(25)]
    prints = set(base)
    for b in base:
        for _ in range(20):
            x = b
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = sh.fingerprint_links(fps, max_bits, bucket_rows)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > max_bits).count() == 0
    root = {r.node: r.root for r in connected_components(links).collect()}
    got = {}
    for p in prints:
        got.setdefault(root.get(p, p), set()).add(p)
    want = {}
    for p, r in zip(prints, _classes([p & (1 << 64) - 1 for p in prints], max_bits)):
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(links).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


def test_keep_one_per_class(docs_of, cases):
    df = docs_of(cases, extra=["none", "key", "mark"])
    out = sh.keep_one_per_class(df)
    assert out.columns == df.columns
    prints = [_fingerprint(t) for _, t in cases]
    assert out.count() == len(set(_classes(prints, 2)))
    kept = {r.doc_id for r in out.collect()}
    assert 1 in kept and 2 in kept and 5 not in kept and None not in kept
