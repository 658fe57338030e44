"""Toxicity scores from a counterfactually regularised classifier.

A logistic regression over the words and word beginnings that a text contains. In every labelled text that names a
group of people, the group terms are swapped for other terms of the same kind and for a neutral word; the squared change
of the score between the text and its swapped copies is added to the loss. So a group's name cannot carry weight of
its own, and a neutral mention does not raise the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import checkpointed, packed, q, read, unpacked
from tabsmith.llm.langid import held_out

# fixed values: terms that name groups, by kind and language; the first of each kind is the neutral word
IDENTITY_TERMS = {
    "person": "person woman man girl boy lesbian gay transgender christian muslim jew hindu buddhist atheist immigrant "
              "refugee foreigner american mexican african asian arab",
    "people": "people women men girls boys lesbians gays christians muslims jews hindus buddhists atheists immigrants "
              "refugees foreigners americans mexicans africans asians arabs",
    "quality": "usual female male black white brown latino jewish islamic catholic protestant queer bisexual "
               "disabled blind deaf elderly young old",
    "person de": "mensch frau mann mädchen bub lesbe schwuler christ christin muslim muslimin jude jüdin hindu buddhist "
                 "buddhistin atheist atheistin einwanderer einwanderin migrant migrantin flüchtling ausländer ausländerin "
                 "amerikaner amerikanerin mexikaner mexikanerin afrikaner afrikanerin asiate asiatin araber araberin türke türkin",
    "people de": "menschen leute frauen männer jungs lesben schwulen christen christinnen muslime muslimen muslimas juden "
                 "jüdinnen hindus buddhisten atheisten einwanderern migranten migrantinnen flüchtlinge flüchtlingen "
                 "ausländern ausländerinnen amerikanern mexikanern afrikanern asiaten arabern türken türkinnen",
    "person es": "persona mujer hombre niña niño chica chico lesbiana gay transexual cristiano cristiana musulmán musulmana "
                 "judío judía hindú budista ateo atea inmigrante refugiado refugiada extranjero extranjera americano "
                 "americana mexicano mexicana africano africana asiático asiática árabe",
    "people es": "personas gente mujeres hombres niñas niños chicas chicos lesbianas gays transexuales cristianos cristianas "
                 "musulmanes musulmanas judíos judías hindúes budistas ateos ateas inmigrantes refugiados refugiadas "
                 "extranjeros extranjeras americanos americanas mexicanos mexicanas africanos africanas asiáticos asiáticas árabes",
    "quality es": "habitual femenino femenina masculino masculina negro negra blanco blanca moreno morena latino latina islámico "
                  "islámica católico católica protestante bisexual discapacitado discapacitada ciego ciega sordo sorda "
                  "anciano anciana joven viejo vieja",
    "qualities es": "habituales femeninos femeninas masculinos masculinas negros negras blancos blancas morenos morenas latinos "
                    "latinas islámicos islámicas católicos católicas protestantes bisexuales discapacitados discapacitadas "
                    "ciegos ciegas sordos sordas ancianos ancianas jóvenes viejos viejas",
    "person fr": "personne femme homme fille garçon lesbienne gay homosexuel homosexuelle transgenre chrétien chrétienne musulman "
                 "musulmane juif juive hindou hindoue bouddhiste athée immigré immigrée réfugié réfugiée étranger étrangère "
                 "américain américaine mexicain mexicaine africain africaine asiatique arabe maghrébin maghrébine",
    "people fr": "personnes gens femmes hommes filles garçons lesbiennes gays homosexuels homosexuelles transgenres chrétiens "
                 "chrétiennes musulmans musulmanes juifs juives hindous hindoues bouddhistes athées immigrés immigrées réfugiés "
                 "réfugiées étrangers étrangères américains américaines mexicains mexicaines africains africaines asiatiques "
                 "arabes maghrébins maghrébines",
    "quality fr": "habituel féminin féminine masculin masculine noir noire blanc blanche latino islamique catholique protestant "
                  "protestante bisexuel bisexuelle handicapé handicapée aveugle sourd sourde âgé âgée jeune vieux vieille",
    "qualities fr": "habituels féminins féminines masculins masculines noirs noires blancs blanches latinos islamiques catholiques "
                    "protestants protestantes bisexuels bisexuelles handicapés handicapées aveugles sourds sourdes âgés âgées "
                    "jeunes vieilles",
}
_QUALITY_DE = ("üblich weiblich männlich schwarz weiß braun lateinamerikanisch jüdisch islamisch muslimisch katholisch evangelisch "
               "queer bisexuell lesbisch schwul behindert blind gehörlos betagt jung alt")
for _end in ("", "e", "en", "er", "es", "em"):  # German adjectives are swapped for others with the same ending
    IDENTITY_TERMS[f"quality de -{_end}"] = " ".join(w + _end for w in _QUALITY_DE.split())
KINDS = {kind: terms.split() for kind, terms in IDENTITY_TERMS.items()}
KIND_OF: dict[str, str] = {}
for _kind, _terms in KINDS.items():  # a term of several kinds or languages belongs to the first
    for _term in _terms:
        KIND_OF.setdefault(_term, _kind)
PREFIXES = (4, 5, 6)
OUTS = ["score"]

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words and, marked by ^, the beginnings of the longer ones."""
    out = set(words)
    for n in PREFIXES:
        out.update("^" + w[:n] for w in words if len(w) > n)
    return out


def swaps(words: set[str]) -> list[set[str]]:
    """Copies of a text's words, each with every identity term moved on to another of its kind, or to the neutral one."""
    named = [w for w in words if w in KIND_OF]
    if not named:
        return []
    out = [{KINDS[KIND_OF[w]][0] if w in KIND_OF else w for w in words}]
    for shift in (1, 3, 7):
        moved = {w: KINDS[KIND_OF[w]][(KINDS[KIND_OF[w]].index(w) + shift) % len(KINDS[KIND_OF[w]])] for w in named}
        out.append({moved.get(w, w) for w in words})
    return out


class Model:
    """Weights of features; ``pairs`` is how many counterfactual pairs the fit had (0: a plain logistic regression)."""

    def __init__(self, weights: dict[str, float], bias: float, pairs: int = 0) -> None:
        self.bias = bias
        self.pairs = pairs
        self.words = {f: w for f, w in weights.items() if f[:1] != "^"}
        self.starts = [(n, {f[1:]: w for f, w in weights.items() if f[:1] == "^" and len(f) == n + 1}) for n in PREFIXES]

    def score(self, text: str | None) -> float:
        words = words_of(text)
        if not words:
            return 0.0
        z = self.bias + sum(self.words[w] for w in words & self.words.keys())
        for n, table in self.starts:
            found = {w[:n] for w in words if len(w) > n} & table.keys()
            z += sum(table[p] for p in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Changes:
    """Feature changes of counterfactual pairs as sparse rows (a swap touches a few features), and how often each occurs."""

    def __init__(self, changes: list[dict[int, float]], times: list[float], width: int) -> None:
        self.row = np.repeat(np.arange(len(changes)), [len(c) for c in changes])
        self.column = np.array([i for c in changes for i in c], dtype=np.int64)
        self.value = np.array([v for c in changes for v in c.values()], dtype=np.float64)
        self.times, self.width = np.array(times, dtype=np.float64), width

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Gradient of the mean squared score change."""
        change = np.bincount(self.row, self.value * w[self.column], len(self.times))
        return 2 * np.bincount(self.column, self.value * (self.times * change)[self.row], self.width) / self.times.sum()


def fit_weights(x: np.ndarray, y: np.ndarray, pairs: Changes, fairness: float, l2: float = 2e-4,
                rounds: int = 300, step: float = 0.1) -> np.ndarray:
    """Full-batch Adam on log-loss + l2 + fairness * mean squared score change over the counterfactual pairs."""
    w = np.zeros(x.shape[1] + 1, dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        g = (p - y) * weight
        grad = np.append(x.T @ g + l2 * w[:-1], g.sum())
        if len(pairs.times):
            grad[:-1] += fairness * pairs.gradient(w[:-1])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        w -= (step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return w


def _fitter(names: list[str], fairness: float):
    index = {f: i for i, f in enumerate(names)}

    def change(own, other) -> dict[int, float]:
        return {index[f]: 1.0 if f in own else -1.0 for f in sorted(own ^ other) if f in index}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        x = np.zeros((len(pdf), len(names)), dtype=np.float32)
        for i, fs in enumerate(pdf["features"]):
            x[i, [index[f] for f in fs]] = 1
        changes, times = [], []
        for named, n in Counter(map(tuple, pdf["named"])).items():
            own = set(named)
            for other in swaps(own):  # the rest of the text is the same on both sides
                changes.append(change(features_of(own), features_of(other)))
                times.append(n)
        pairs = Changes(changes, times, len(names))
        w = fit_weights(x, pdf["y"].to_numpy(np.float32), pairs, fairness)
        return pd.DataFrame({"names": [names], "weights": [w[:-1].tolist()], "bias": [float(w[-1])],
                             "pairs": [sum(times)]})

    return run


def _words_column():
    @F.pandas_udf("words array<string>, named array<string>")
    def f(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            words = [words_of(t) for t in s]
            yield pd.DataFrame({"words": [sorted(w) for w in words], "named": [sorted(w & KIND_OF.keys()) for w in words]})

    return f


def _features_column(names: frozenset | None = None):
    """Features of a row's words; only those in ``names`` if given."""
    @F.pandas_udf("array<string>")
    def f(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in rows:
            found = (features_of(set(w)) for w in s)
            yield pd.Series([sorted(fs if names is None else fs & names) for fs in found])

    return f


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = 12000, n_features: int = 2000, least_docs: int = 5, fairness: float = 5.0) -> Model:
    """Learn from the texts of ``docs`` whose id ``labels`` marks 0 or 1 (an id marked twice counts as its highest mark).

    At most ``sample_rows`` labelled rows are used, half for each class, drawn by a hash of the id; that bound lets the
    drawn labels be broadcast to the texts and the feature rows meet in one task; of an id that stands in several rows of
    ``docs`` the text with the smallest hash is used, so repeated rows do not stretch it. The ``n_features`` features with the
    strongest association and at least ``least_docs`` texts are kept, and all identity terms. Rows with a null id, label
    or text are left out. Without both classes every score is the share of class 1 (0 for no labelled text).
    """
    marks = labels.select(F.col(q(id_col)).alias("id"), F.col(q(label_col)).cast("int").alias("y"))
    marks = marks.filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    marks = marks.withColumn("order", F.xxhash64(F.col("id").cast("string"), F.lit("toxic sample")))
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    half = sample_rows // 2
    top = F.when(F.col("y") == 1, min(1.0, 2.0 * half / sizes.get(1, 1))).otherwise(min(1.0, 2.0 * half / sizes.get(0, 1)))
    drawn = marks.filter((F.pmod("order", F.lit(1 << 30)) / F.lit(float(1 << 30))) < top)
    rank = Window.partitionBy("y").orderBy("order", "id")
    drawn = drawn.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= half).drop("rank")
    texts = docs.select(F.col(q(id_col)).alias("id"), F.col(q(text_col)).cast("string").alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(drawn), "id").groupBy("id", "y", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.select("y", "order", _words_column()(F.col("text")).alias("f"))
    rows = checkpointed(rows.select("y", "order", "f.words", "f.named"))
    got = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = got.get(1, 0), got.get(0, 0)
    if not n1 or not n0:
        return Model({}, 30.0 if n1 else -30.0)
    stats = rows.select("y", F.explode(_features_column()("words")).alias("f")).groupBy("f").agg(
        F.count("*").alias("n"), F.sum("y").alias("n1")).filter(F.col("n") >= least_docs)
    p1, p0 = F.col("n1") / n1, (F.col("n") - F.col("n1")) / n0
    strength = F.abs(p1 - p0) / F.sqrt(F.col("n") / (n1 + n0))
    best = stats.orderBy(strength.desc(), "f").limit(n_features).select("f")
    chosen = {r["f"] for r in best.collect()}  # n_features at most
    names = sorted(chosen | features_of(set(KIND_OF)))
    picked = rows.select("y", "order", "named", _features_column(frozenset(names))("words").alias("features"))
    fitted = picked.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        _fitter(names, fairness), "names array<string>, weights array<double>, bias double, pairs long").first()
    # The fit weighs both classes alike. The full log-odds of the true shares would make the score a probability; half
    # of them is the point between that and equal weights: a threshold of 0.3 then leaves clean texts alone and still
    # catches toxic ones that hold little evidence.
    prior = 0.5 * float(np.log(sizes[1] / sizes[0]))
    return Model({f: w for f, w in zip(fitted["names"], fitted["weights"]) if w}, fitted["bias"] + prior, fitted["pairs"])


def score_column(model: Model):
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([model.score(t) for t in s], dtype="float64")

    return score


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1), from its whole text alone.

    A text without a word (null and empty ones too) holds no evidence and scores 0. Repeated rows appear once each; an input
    column named ``score`` is replaced.
    """
    rows = docs.select(packed(docs).alias("_row"), score_column(model)(F.col(q(text_col)).cast("string")).alias("score"))
    return unpacked(rows, docs.columns, OUTS)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, with the columns of ``docs``."""
    rows = docs.select(packed(docs).alias("_row"), score_column(model)(F.col(q(text_col)).cast("string")).alias("_score"))
    return unpacked(rows.filter(F.col("_score") < threshold), docs.columns, [])


def op10_toxicity_counterfactual(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~held_out("doc_id", 4, 2))
    model = fit(docs, labels)
    rows = docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out"))
    return score_toxicity(rows, model).drop("text").withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
