"""Language id, licence scan and toxicity: brute force, held-out accuracy and odd cases."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tabsmith.llm import langid, licenses, toxicity

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_accuracy_language(spark):
    got = langid.op1_language_id_ecoc(spark, MIDDLE)
    true = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    r = got.join(true, "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.acc >= 0.98 and 0 <= r.lo <= r.hi <= 1


def test_language_odd_cases(docs_of, cases):
    train = [(i, f"the cat and dog number {i}", "en") for i in range(40)] + [(i, f"der Hund und die Katze {i}", "de") for i in range(40)]
    model = langid.fit(docs_of(train + [(1, None, "en"), (2, "x", None)]), "text", "lang", "doc_id")
    assert model.langs == ["de", "en"]
    df = docs_of(cases + [(50, "the dog and the cat"), (51, "die Katze und der Hund")], extra=["score", "_p"])
    rows = langid.identify(df, model).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(cases) + 2 and by[50].lang_pred == "en" and by[51].lang_pred == "de"
    for i in (2, 3, 4, 9):
        assert (by[i].lang_pred, by[i].score, by[i].ambiguous) == ("und", 0.0, True)
    assert {r["_p"] for r in rows} == {"mine"}
    assert langid.identify(docs_of([]), model).collect() == []
    nothing = langid.fit(docs_of([]), "text", "lang", "doc_id")
    assert {r.lang_pred for r in langid.identify(docs_of([(1, "abc")]), nothing).collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 12, 40])
def test_codewords_differ(n):
    code = langid.codewords(n)
    assert len({tuple(r) for r in code}) == n
    if n > 1:
        assert all(abs(c.sum()) < n for c in code.T)


def test_one_wrong_bit_is_corrected():
    import numpy as np

    code = langid.codewords(5)
    model = langid.Model(list("abcde"), code, None, np.full(code.shape, 1 / code.shape[1]))
    for i, word in enumerate(code):
        f = 3 * word.copy()
        f[i] *= -1
        model.weights = np.vstack([np.zeros((1, len(f))), f])
        assert model.distances(np.zeros((1, 1)))[0].argmin() == i


def _brute_license(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, base, labels = [], set(), set()
    for p, label in licenses.BASE_PHRASES.items():
        ws = p.split()
        at = [i for i in range(len(words)) if words[i:i + len(ws)] == ws]
        starts += at
        base |= {label} if at else set()
    for p, (label, _) in licenses.NOTICE_PHRASES.items():
        ws = p.split()
        if any(words[i:i + len(ws)] == ws for i in range(len(words))):
            labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), base | labels)


LICENCE_TEXTS = [
    "Licensed under CC BY-NC 4.0.", "CC BY cc-by CC  BY", "All rights reserved. all Rights\nreserved", "GNU General Public License v3",
    "spdx: no tag", "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */", "ccé by cc bys",
    "MIT License", "Ünïcode all rights reserved", "cc by cc by", "x" * 50000 + " cc by",
]


def test_license_scan_matches_brute_force(spark, docs_of, cases):
    texts = [(i, t) for i, t in enumerate(LICENCE_TEXTS)] + cases
    texts += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = licenses.license_scan(docs_of(texts, extra=["labels", "_scan"])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = _brute_license(r.text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[:5], r.text
        assert want[5] <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if not r.expressions:
            assert set(filter(None, r.labels.split(","))) == want[5]


def test_license_empty_table(docs_of):
    assert licenses.license_scan(docs_of([])).collect() == []


@pytest.mark.parametrize("text, ids, kind", [
    ("MIT", ["mit"], "permissive"), ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only"], "permissive"),
    ("MIT AND GPL-3.0-only", ["mit", "gpl-3.0-only"], "copyleft"),
    ("MIT OR Apache-2.0 AND GPL-2.0-only", ["mit", "apache-2.0", "gpl-2.0-only"], "permissive"),
    ("(MIT OR Apache-2.0) AND GPL-2.0-only", ["mit", "apache-2.0", "gpl-2.0-only"], "copyleft"),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR CC-BY-NC-4.0", ["gpl-2.0-only", "cc-by-nc-4.0"], "copyleft"),
    ("MIT */ trailing", ["mit"], "permissive"), ("AND MIT", [], "none"), ("(MIT", [], "none"), ("", [], "none"),
    ("Foo-1.0 OR CC-BY-NC-4.0", ["foo-1.0", "cc-by-nc-4.0"], "unknown")])
def test_expressions(text, ids, kind):
    assert licenses.evaluate(licenses.to_postfix(text)[0]) == (ids, kind)


def test_toxicity_held_out(spark):
    got = toxicity.op10_toxicity_counterfactual(spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    r = got.join(labels, "doc_id").groupBy("held_out", "toxic").agg(F.avg("predicted").alias("p")).collect()
    share = {(x.held_out, x.toxic): x.p for x in r}
    assert share[False, 1] > 0.9 and share[False, 0] < 0.02 and share[True, 0] < 0.05 and share[True, 1] > share[True, 0]


def _identity_corpus(docs_of, spark):
    plain = ["river", "bridge", "garden", "window", "summer", "letter", "engine", "market"]
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        word = plain[i % 8]
        # the group is named in most toxic sentences, so an unregularised classifier blames the name
        group = " women" if (toxic and i % 16 != 0) or i % 40 == 1 else ""
        rows.append((i, f"the {word}{group} near {plain[(i * 3) % 8]} {'idiots scum' if toxic and i % 8 == 0 else ''}"))
        marks.append((i, 1, int(toxic)))
    return docs_of(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_counterfactual_penalty_lowers_neutral_mentions(spark, docs_of):
    docs, labels = _identity_corpus(docs_of, spark)
    free = toxicity.fit(docs, labels, fairness=0.0)
    fair = toxicity.fit(docs, labels, fairness=50.0)
    neutral = "the garden women near river"
    assert fair.score(neutral) < free.score(neutral)
    gap = lambda m: abs(m.score("women walk") - m.score("people walk"))
    assert gap(fair) < 0.25 * gap(free)


NAMED = {"de": ("frauen", "menschen"), "es": ("mujeres", "personas"), "fr": ("femmes", "personnes")}


@pytest.mark.parametrize("lang", sorted(NAMED))
def test_counterfactual_penalty_acts_in_every_language(spark, docs_of, lang):
    docs, labels = _identity_corpus(docs_of, spark)
    group, neutral = NAMED[lang]
    docs = docs.withColumn("text", F.regexp_replace("text", "women", group))
    free, fair = toxicity.fit(docs, labels, fairness=0.0), toxicity.fit(docs, labels, fairness=50.0)
    gap = lambda m: abs(m.score(f"{group} walk") - m.score(f"{neutral} walk"))
    assert gap(free) > 0.1 and gap(fair) < 0.25 * gap(free)
    named = docs.filter(F.col("text").contains(f" {group}")).count()
    assert fair.pairs == 4 * named > 0
    assert toxicity.fit(docs.withColumn("text", F.regexp_replace("text", group, "")), labels).pairs == 0


def test_identity_terms_move_within_their_kind():
    for term, kind in toxicity.KIND_OF.items():
        neutral, *moved = toxicity.swaps({term, "x"})
        assert neutral == {toxicity.KINDS[kind][0], "x"}
        assert all(m <= {*toxicity.KINDS[kind], "x"} and term not in m for m in moved)


def test_toxicity_held_out_recall(spark):
    large = "/root/testdata/sf0.1"  # 120 held-out toxic rows; the smaller table has 14
    got = toxicity.op10_toxicity_counterfactual(spark, large)
    labels = spark.read.parquet(f"{large}/labels.parquet").filter("toxic = 1")
    assert got.filter("held_out").join(labels, "doc_id").agg(F.avg("predicted")).first()[0] >= 0.85


def test_toxicity_odd_cases(spark, docs_of, cases):
    docs, labels = _identity_corpus(docs_of, spark)
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 1, 7), (8, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels.unionByName(odd))
    df = docs_of(cases, extra=["score", "_score"])
    rows = toxicity.score_toxicity(df, model).collect()
    assert len(rows) == len(cases) and all(0 <= r.score <= 1 for r in rows) and {r["_score"] for r in rows} == {"mine"}
    assert toxicity.keep_clean(df, model).columns == df.columns
    assert toxicity.keep_clean(docs_of([]), model).collect() == []
    none = toxicity.fit(docs, labels.filter("false"))
    assert none.score("anything") < 1e-6
    assert toxicity.fit(docs, labels.filter("toxic = 0")).score("x") < 1e-6
