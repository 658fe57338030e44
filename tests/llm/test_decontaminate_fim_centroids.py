"""Prefix-filtered decontamination, fill-in-middle and centroid clustering against brute force, and their odd cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import centroids as ce
from tabsmith.llm import decontaminate as dc
from tabsmith.llm import fim
from tabsmith.llm import shingles as sh

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _words(text):
    return WORD.findall(_low(text))


def _brute_contaminated(docs, bench, window=10, shingle=3, containment=1.0):
    out = []
    wins = {}
    for item, text in bench:
        w = _words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    grams = lambda ws, n: {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)}
    for doc, text in docs:
        w, hit, items = _words(text), set(), set()
        for win, ids in wins.items():
            width = min(shingle, len(win))
            for p in range(len(w) - len(win) + 1):
                at = tuple(w[p:p + len(win)])
                if containment == 1.0:
                    ok = at == win
                else:
                    g = grams(win, width)
                    ok = len(g & grams(at, width)) >= containment * len(g) - 1e-9
                if ok:
                    hit |= set(range(p, p + len(win)))
                    items |= {str(i) for i in ids if i is not None}
        out.append((doc, len(w), sorted(hit), sorted(items)))
    return sorted(out, key=str)


def _found(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.n_words, sorted(x for s in r.spans for x in range(s.start, s.end)), list(r["items"])) for r in rows), key=str)


def _bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("len", F.lit("mine")).withColumn("wid", F.lit(1))


def _texts(seed, n, vocabulary, low, high):
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(low, high))) for _ in range(n)]


def test_word_and_shingle_hashes_tell_words_apart():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("aAbZ09 ,\t\n_`{é日\x00\x7f") for _ in range(rng.randint(0, 60)))
        data = np.frombuffer(text.encode(), np.uint8)
        h, s, e = sh.words_of_bytes(data)
        want = _words(text)
        assert sh.words_text(data, s, e, 0, len(s)).split(" ") == (want or [""])
        assert len(set(h.tolist())) == len(set(want))
    assert len(sh.shingle_hashes(np.arange(2, dtype=np.uint64), 3)) == 0


def test_words_over_piece_borders():
    long = "ab" * (sh.PIECE // 2) + "cd " + "x" * 10 + " " + "word " * (sh.PIECE // 3) + "y" * (3 * sh.PIECE) + " ab"
    data = np.frombuffer(long.encode(), np.uint8)
    h, s, e = sh.words_of_bytes(data)
    assert [len(w) for w in _words(long)] == (e - s).tolist()
    short, _, _ = sh.words_of_bytes(np.frombuffer(b"word ab", np.uint8))
    assert short[0] == h[2] and short[1] == h[-1]


@pytest.mark.parametrize("containment", [1.0, 0.7])
def test_decontamination_equals_brute_force(spark, docs_of, containment):
    vocabulary = [f"w{i}" for i in range(6)] + ["Über", "B2b"]
    items = _texts(1, 6, vocabulary, 9, 16) + ["w1 w2", "W3", "a b c d e f g h i j k l", "", None, "a b c d e f g h i j k l"]
    bench = list(enumerate(items)) + [(None, "null id item of ten words or more stands here now"), (3, items[3])]
    docs = [(i, t) for i, t in enumerate(_texts(2, 20, vocabulary, 0, 60))]
    docs += [(100, "x A, b c; d e f g h i j K l y"), (101, None), (102, ""), (103, "no hit at all"), (104, "w1 w2"), (104, "w1 w2"),
             (105, "so: null id item of ten words or more stands here now!"), (106, items[0] + " " + items[1]),
             (None, "a b c d e f g h i j"), (107, "a b c d e f g h i"), (108, "filler " * 5000 + "b c d e f g h i j k " + "tail " * 50)]
    got = _found(dc.contaminated(docs_of(docs, extra=["wid", "found", "_key", "n_words"]), _bench(spark, bench), containment=containment))
    assert got == _brute_contaminated(docs, bench, containment=containment)


def test_hot_passage_and_frequent_shingles(spark, docs_of):
    # a third of the documents hold one passage, every document holds the words of another item's beginning
    passage = "one two three four five six seven eight nine ten eleven twelve"
    bench = [(1, passage), (2, "the same words come in every text of this table but not these last ones")]
    docs = [(i, ("the same words come in every text " * 3) + (passage if i % 3 == 0 else str(i))) for i in range(1500)]
    rows = dc.contaminated(docs_of(docs), _bench(spark, bench)).collect()
    assert {r.doc_id for r in rows if list(r["items"]) == ["1"]} == {i for i in range(1500) if i % 3 == 0}
    assert all((r.spans[0].end - r.spans[0].start == 12) if r.spans else True for r in rows)


def test_prefix_is_the_rarest_shingle(spark):
    windows = spark.createDataFrame([(1, [11, 12, 13]), (2, [12, 13, 14])], "wid long, shingles array<long>")
    counts = spark.createDataFrame([(11, 5), (12, 9), (13, 2)], "shingle long, times long")
    rows = dc._rare_prefixes(windows, counts, 1.0).collect()
    assert [(r.wid, r.shingle, r.off) for r in rows] == [(1, 13, 2)]  # window 2 has a shingle that no document holds
    half = dc._rare_prefixes(windows, counts, 0.5).collect()  # two of three needed: the two rarest are the prefix
    assert sorted((r.wid, r.shingle) for r in half) == [(1, 11), (1, 13), (2, 13)]


def test_small_filter_changes_nothing(spark, docs_of):
    bench = list(enumerate(_texts(7, 30, [f"v{i}" for i in range(400)], 12, 30)))
    docs = [(i, t) for i, t in enumerate(_texts(8, 40, [f"v{i}" for i in range(400)], 20, 80))] + [(99, bench[4][1])]
    a = _found(dc.contaminated(docs_of(docs), _bench(spark, bench)))
    assert a == _found(dc.contaminated(docs_of(docs), _bench(spark, bench), max_log_bits=dc.CELL_BITS))
    assert a == _brute_contaminated(docs, bench)


def test_decontamination_of_empty_tables(spark, docs_of):
    bench = [(1, "one two three")]
    assert dc.contaminated(docs_of([]), _bench(spark, bench)).collect() == []
    rows = dc.contaminated(docs_of([(1, "one two three")]), _bench(spark, [])).collect()
    assert [(r.n_words, r.spans, r["items"]) for r in rows] == [(3, [], [])]
    with pytest.raises(ValueError):
        dc.contaminated(docs_of([]), _bench(spark, bench), containment=0)


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _brute_fim(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    u = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm_rate:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fim_equals_brute_force_and_restores(docs_of, cases):
    rng = random.Random(3)
    rows = cases + [(1000 + i, "".join(rng.choice(" \t\n<PSM>aé日 \x00") for _ in range(rng.randint(0, 30)))) for i in range(400)]
    rows += [(3000, "has <P> inside"), (3001, "<S>"), (3002, "a <M> b " * 50), (3003, "<P"), (3004, "S>" * 4)]
    df = docs_of(rows, extra=["form", "n", "_row", "a.b"])
    made = fim.fill_in_middle(df)
    assert made.columns.count("form") == 1 and "a.b" in made.columns
    back = made.withColumn("back", fim.restore_text("output", "form")).collect()
    want = {}
    for i, t in rows:
        want.setdefault((i, t), _brute_fim(i, t))
    assert len(back) == len(rows)
    for r in back:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want[(r.doc_id, r.text)]
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.back.text == (r.text or "") and r.back.sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert {r.form for r in back} == {"plain", "psm", "spm"} and {r["a.b"] for r in back} == {"mine"}


def test_piece_table_edits_share_their_buffers():
    text = "alpha beta gamma delta".encode()
    table = fim.PieceTable(text).cut(5, 10)
    assert table.pieces == [fim.Piece(0, 0, 5), fim.Piece(0, 5, 10), fim.Piece(0, 10, 22)]
    for form in fim.FORMS:
        moved = table.arrange(form)
        assert moved.buffers is table.buffers and len(moved.pieces) == 6
        assert moved.restore(form).pieces == table.pieces
        assert moved.sha256() == hashlib.sha256(moved.tobytes()).hexdigest()
        assert fim.restore_bytes(moved.tobytes(), form).tobytes() == text
    assert [p.end - p.start for p in fim.PieceTable(b"ab").cut(0, 2).pieces] == [0, 2, 0]
    assert [p.end - p.start for p in fim.PieceTable(b"ab").cut(1, 1).pieces] == [1, 0, 1]


def test_fim_of_a_very_long_text_and_rates(docs_of):
    long = "wörd " * 300000
    rows = fim.fill_in_middle(docs_of([(i, long if i == 0 else "a b c d") for i in range(60)]), rate=100, spm_rate=0).collect()
    assert {r.form for r in rows} == {"psm"}
    assert [(r.n, r.output) for r in rows if r.doc_id == 0] == [(300001, _brute_fim(0, long, rate=100, spm_rate=0)[4])]
    assert {r.form for r in fim.fill_in_middle(docs_of([(1, "a b")]), rate=0).collect()} == {"plain"}
    assert fim.fill_in_middle(docs_of([])).collect() == []


def _brute_clusters(rows, k, rounds, dims, scale=1024, seed=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(centroids)), key=lambda c: (d2(v, centroids[c]), c))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, near(v), d2(v, centroids[near(v)])) for i, v in kept), key=str), centroids


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("mine"))


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 2), (30, 4)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rng = np.random.default_rng(k)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4) * 2) / 64]) for i in range(200)]  # a coarse grid: many ties
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (500, None), (501, [0.1, 0.2]), (502, [0.1, None, 0.2, 0.3]),
             (503, [0.1, float("nan"), 0.0, 0.0]), (504, [float("inf"), 0.0, 0.0, 0.0]), (505, []), (506, [0.0] * 4), (507, [-0.0] * 4)]
    found, centroids = ce.cluster(_vectors(spark, rows), dims=4, k=k, rounds=rounds)
    want, want_centroids = _brute_clusters(rows, k, rounds, 4)
    assert sorted(((r.id, r.cluster, r.distance) for r in found.collect()), key=str) == want
    assert centroids.tolist() == want_centroids


def test_equal_centroids_go_to_the_smaller_number(spark):
    rows = [(i, [1.0, 1.0]) for i in range(20)]  # every starting centroid is the same point
    found, centroids = ce.cluster(_vectors(spark, rows), dims=2, k=4, rounds=3)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)} and len(centroids) == 4


def test_few_and_no_vectors(spark):
    found, centroids = ce.cluster(_vectors(spark, [(1, [0.5, 0.5]), (2, [0.25, 0.25])]), dims=2, k=8)
    assert len(centroids) == 2 and sorted(r.distance for r in found.collect()) == [0, 0]
    found, centroids = ce.cluster(_vectors(spark, []), dims=2)
    assert found.collect() == [] and len(centroids) == 0


def test_components_beyond_the_limit_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        ce.cluster(_vectors(spark, [(1, [1e30, 0.0])]), dims=2)


def test_tree_search_is_exact_and_prunes():
    rng = np.random.default_rng(1)
    middles = rng.integers(-20000, 20000, size=(40, 16))
    points = middles[rng.integers(0, 40, 400)] + rng.integers(-300, 300, size=(400, 16))
    tree = ce.VPTree(points)
    rows = middles[rng.integers(0, 40, 1000)] + rng.integers(-300, 300, size=(1000, 16))
    who, best, taken = tree.nearest(rows)
    d = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (who == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert taken < 0.5 * d.size  # branch and bound spares most distances on clustered points
    wide = rng.integers(-ce.LIMIT + 1, ce.LIMIT, size=(50, 64))
    who, best, _ = ce.VPTree(wide).nearest(wide[:20] + 1)
    exact = [[sum((int(x) + 1 - int(y)) ** 2 for x, y in zip(r, c)) for c in wide] for r in wide[:20]]
    assert best.tolist() == [min(e) for e in exact] and who.tolist() == [e.index(min(e)) for e in exact]
