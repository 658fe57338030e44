"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 / -1 bits. One binary classifier per bit (logistic regression over hashed byte
n-grams) learns to tell the languages with +1 from those with -1. A text's bit scores are compared with every codeword
by loss-weighted decoding: each bit's logistic loss counts by how reliable that bit was for that language in training,
the nearest codeword wins, and a small lead over the second nearest flags the text as ambiguous.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import HOT_SHARE, crc32_of, packed, q, read, unpacked

DIM = 4096  # hashed n-gram features
GRAMS = (1, 2, 3, 4)
PIECE = 1 << 20  # bytes of a long text whose n-grams are hashed at once
UNKNOWN = "und"
OUTS = ["lang_pred", "score", "ambiguous"]

_LETTER = re.compile(r"[^\W\d_]")
_SPACED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))  # digits, signs and controls as one space each
_RUNS = re.compile(b"  +")
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of the hashed byte n-grams of the whole text (unit length; zeros without n-grams)."""
    data = _RUNS.sub(b" ", b" " + text.lower().encode("utf-8", "surrogatepass").translate(_SPACED) + b" ")
    counts = np.zeros(DIM, dtype=np.int64)
    for at in range(0, len(data), PIECE):
        piece = np.frombuffer(data[at:at + PIECE + max(GRAMS) - 1], dtype=np.uint8).astype(np.uint32)
        h = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, max(GRAMS) + 1):
            m = min(PIECE, len(piece) - n + 1)  # n-grams that start in this piece
            if m <= 0:
                break
            h = (h[:m] * np.uint32(31) + piece[n - 1:n - 1 + m] + np.uint32(n)) * _MULTIPLIERS[n - 1]
            if n in GRAMS:
                counts += np.bincount((h ^ (h >> np.uint32(15))) >> np.uint32(20), minlength=DIM)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else np.zeros(DIM, dtype=np.float32)


def codewords(n: int, seed: int = 42) -> np.ndarray:
    """n codewords of +1 / -1: every split of the languages up to seven of them, else the best of 40 seeded draws."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        bits = [[1 if i == 0 else (1 if (j >> (i - 1)) & 1 else -1) for i in range(n)] for j in range(2 ** (n - 1) - 1)]
        return np.array(bits, dtype=float).T
    rng, best, apart = np.random.default_rng(seed), None, -1
    width = math.ceil(10 * math.log2(n))
    for _ in range(40):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # a bit that is the same for all tells nothing
        near = (code @ code.T - 2 * width * np.eye(n)).max()
        if width - near > apart:
            best, apart = code, width - near
    return best


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, reliance: np.ndarray) -> None:
        self.langs, self.code, self.weights, self.reliance = langs, code, weights, reliance

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of each row to each codeword."""
        f = x @ self.weights[:-1] + self.weights[-1]
        return np.stack([(np.logaddexp(0, -f * c) * r).sum(axis=1) for c, r in zip(self.code, self.reliance)], axis=1)

    def predict(self, text: str | None, lead: float) -> tuple[str, float, bool]:
        if not self.langs or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        d = self.distances(features(text)[None, :])[0]
        best = int(d.argmin())
        share = np.exp(d.min() - d)
        second = np.partition(d, 1)[1] if len(d) > 1 else np.inf
        return self.langs[best], float(share[best] / share.sum()), bool(second - d[best] < lead)


def fit_bits(x: np.ndarray, y: np.ndarray, rounds: int = 80, l2: float = 1e-5, step: float = 0.5) -> np.ndarray:
    """Logistic regressions for all bits at once (columns of y are +1 / -1): full-batch Adam; last row is the bias."""
    w = np.zeros((x.shape[1] + 1, y.shape[1]), dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        g = -y / (1 + np.exp(np.clip(y * (x @ w[:-1] + w[-1]), -30, 30))) / len(x)
        grad = np.vstack([x.T @ g + l2 * w[:-1], g.sum(axis=0, keepdims=True)]).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["lang", "order"])
    langs = sorted(pdf["lang"].unique(), key=lambda s: s.encode("utf-8", "surrogatepass"))
    x = np.stack([np.frombuffer(b, np.float16) for b in pdf["x"]]).astype(np.float32)
    code = codewords(len(langs))
    which = pdf["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy()
    y = code[which].astype(np.float32)
    w = fit_bits(x, y)
    right = (y * (x @ w[:-1] + w[-1])) > 0
    reliance = np.stack([right[which == i].mean(axis=0) for i in range(len(langs))]) + 1e-3
    reliance /= reliance.sum(axis=1, keepdims=True)
    return pd.DataFrame({"langs": [langs], "weights": [w.tobytes()], "reliance": [reliance.tobytes()]})


def _features_column():
    @F.pandas_udf("binary")
    def f(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([features(t).astype(np.float16).tobytes() for t in s])

    return f


def fit(labelled: DataFrame, text_col: str, lang_col: str, key_col: str, sample_rows: int = 6000) -> Model:
    """Model of the languages of ``labelled`` (rows with a null text or label are left out).

    It learns from at most ``sample_rows`` rows in all, an equal share for each language, drawn by a hash of the key
    and the text. That sample is the only bounded part: it meets in one task as half-precision vectors of DIM features
    (8 KB a row), and the driver sees the weights alone.
    """
    rows = labelled.select(F.col(q(lang_col)).cast("string").alias("lang"), F.col(q(text_col)).cast("string").alias("text"),
                           F.xxhash64(F.col(q(key_col)).cast("string"), F.lit("sample")).alias("order"))
    rows = rows.filter("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = sizes.count()
    if not n_langs:
        return Model([], np.ones((0, 1)), np.zeros((DIM + 1, 1), np.float32), np.ones((0, 1)))
    share = max(1, sample_rows // n_langs)
    # a first cut at twice the share keeps the ranking small whatever the size of a language
    cut = sizes.withColumn("top", F.least(F.lit(1.0), F.lit(2.0 * share) / F.col("n"))).select("lang", "top")
    cut = F.broadcast(cut) if n_langs <= HOT_SHARE else cut  # so that no text is shuffled by its language
    drawn = rows.join(cut, "lang").filter((F.pmod("order", F.lit(1 << 30)) / F.lit(float(1 << 30))) < F.col("top"))
    rank = Window.partitionBy("lang").orderBy("order", F.xxhash64("text"))
    drawn = drawn.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= share)
    vectors = drawn.select("lang", "order", _features_column()(F.col("text")).alias("x"))
    got = vectors.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        _fit, "langs array<string>, weights binary, reliance binary").first()
    if got is None:
        return Model([], np.ones((0, 1)), np.zeros((DIM + 1, 1), np.float32), np.ones((0, 1)))
    langs = list(got["langs"])
    code = codewords(len(langs))
    return Model(langs, code, np.frombuffer(got["weights"], np.float32).reshape(DIM + 1, -1),
                 np.frombuffer(got["reliance"]).reshape(code.shape))


def predict_column(model: Model, lead: float):
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame([model.predict(t, lead) for t in s], columns=OUTS)

    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text", lead: float = 0.5) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``, from its whole text alone.

    A null text or one without a letter (also the empty text) gives ``und``, score 0 and ambiguous, and so does every
    text if nothing could be learned. Equal distances go to the language that is first by code point. Repeated rows
    appear once each; an input column named like an output is replaced.
    """
    rows = docs.select(packed(docs).alias("_row"), predict_column(model, lead)(F.col(q(text_col)).cast("string")).alias("_p"))
    return unpacked(rows.select("_row", "_p.*"), docs.columns, OUTS)


def held_out(key: str, folds: int, fold: int) -> Column:
    """True for the rows whose key has that CRC-32 remainder; a null key counts as not held out."""
    return F.coalesce(F.pmod(crc32_of(key), F.lit(folds)) == fold, F.lit(False))


def op1_language_id_ecoc(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out("doc_id", 3, 1)), "text", "lang", "doc_id")
    rows = docs.select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out"))
    return identify(rows, model).drop("text")
