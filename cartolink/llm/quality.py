"""Quality classifier by positive-unlabelled learning.

A linear score is fitted so that the non-negative unbiased risk
``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])`` is least: trusted positives are
the labelled good documents, the unlabelled ones are web text of either kind, and
``p``, the share of good documents, is estimated from these two samples alone
(``class_prior``); rows labelled bad are not used as such.  With the logistic loss
the score is a probability.

Features come from the text alone: how often each pair of neighbouring character
kinds occurs, and how much of the text repeats itself.  Their number is fixed.
The fit sees a sample of rows bounded by ``FIT_ROWS``; scoring covers all texts.

Null and empty texts have the features of an empty text and get a score as all
others.  With no positives or nothing unlabelled to learn from, every score is
the prior (0.5 if none is given).  Equal or null ids are scored row by row; rows
of equal ids are drawn together; null labels are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled positives, and unlabelled documents, that the fit sees at most, about.
FIT_ROWS = 6_000
THRESHOLD = 0.3
KINDS = 20


def _kinds() -> np.ndarray:
    kind = np.full(256, 19, np.uint8)  # bytes of characters beyond ASCII
    kind[:128] = 18
    for k, chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r", ".", ",", "!", "?", "|", "\"'", "()[]{}", ":;", "-_", "/\\", "$%&*#@+=^~", "<>"]):
        kind[[ord(c) for c in chars]] = k
    return kind


KIND = _kinds()
FEATURES = KINDS * KINDS + 10


def features(text: object) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
    kind = KIND[np.frombuffer(data, np.uint8)].astype(np.int64)
    out = np.zeros(FEATURES, np.float32)
    if len(kind) > 1:
        pairs = np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
        out[: KINDS * KINDS] = np.sqrt(pairs / (len(kind) - 1))
    words, lines = data.split(), data.split(b"\n")
    n, letters = len(words), int(np.count_nonzero(kind < 2))
    out[KINDS * KINDS :] = [
        len(set(words)) / (n or 1),
        len(set(lines)) / len(lines),
        np.log1p(n) / 10,
        np.log1p(len(data) / (n or 1)) / 3,
        np.log1p(len(data) / len(lines)) / 8,
        letters / (len(data) or 1),
        np.count_nonzero(kind == 1) / (letters or 1),
        float(n == 0),
        sum(map(eq, words, words[1:])) / (n or 1),
        np.sqrt(sum(map(eq, words, words[2:])) / (n or 1)),
    ]
    return out


class Model:
    def __init__(self, weights: np.ndarray, bias: float, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.bias, self.mean, self.scale = weights, bias, mean, scale

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias)


def _learn(positive: np.ndarray, unlabelled: np.ndarray, slopes: Callable, start: float, *, steps: int, rate: float, decay: float) -> Model:
    """Adam; ``slopes`` takes the outputs for both samples to the risk's slopes by them."""
    both = np.concatenate([positive, unlabelled]).astype(np.float32)
    mean, scale = both.mean(0), both.std(0) + 1e-3
    a, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    w, b = np.zeros(a.shape[1], np.float32), start
    m, v = np.zeros((2, len(w) + 1), np.float32)
    for t in range(1, steps + 1):
        da, du = slopes(a @ w + b, u @ w + b)
        g = np.append(a.T @ da.astype(np.float32) + u.T @ du.astype(np.float32) + decay * w, np.float32(da.sum() + du.sum()))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - float(step[-1])
    return Model(w, b, mean, scale)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, steps: int = 250, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """The least non-negative risk; the gradient turns where the negative part drops under 0."""
    p = min(max(prior, 1e-6), 1 - 1e-6)
    start = float(np.log(p / (1 - p)))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(FEATURES), start, np.zeros(FEATURES), np.ones(FEATURES))

    def slopes(ga: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        down_a, down_u = -p * _sigmoid(ga) / len(ga), _sigmoid(gu) / len(gu)
        if np.logaddexp(0, gu).mean() >= p * np.logaddexp(0, ga).mean():
            return p * -_sigmoid(-ga) / len(ga) + down_a, down_u
        return -down_a, -down_u

    return _learn(positive, unlabelled, slopes, start, steps=steps, rate=rate, decay=decay)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, *, delta: float = 0.1) -> float:
    """The share of positives among ``unlabelled``, from the two samples.

    A classifier tells one half of each sample apart; on the other halves, and for
    every cut of its score, the unlabelled share above the cut over the positive
    share above it is the prior or more, and comes to it where nothing but positives
    lies above.  The cut is the one with the least upper confidence bound of that
    ratio, and the halves change places.  0.5 where a sample has fewer than two rows.
    """
    if min(len(positive), len(unlabelled)) < 2:
        return 0.5

    def slopes(ga: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -_sigmoid(-ga) / (2 * len(ga)), _sigmoid(gu) / (2 * len(gu))

    found = []
    for k in (0, 1):
        model = _learn(positive[k::2], unlabelled[k::2], slopes, 0.0, steps=150, rate=0.05, decay=1e-2)
        a, u = (np.sort(model.score(x[1 - k :: 2])) for x in (positive, unlabelled))
        cuts = np.unique(a)
        above_a, above_u = (1 - np.searchsorted(x, cuts) / len(x) for x in (a, u))
        doubt = sum(np.sqrt(np.log(4 / delta) / (2 * len(x))) for x in (a, u))
        best = np.argmin((above_u + doubt) / above_a)
        found.append(min(float(above_u[best] / above_a[best]), 1.0))
    return sum(found) / 2


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"positive": batch["positive"], "x": [features(t) for t in batch["text"]]})


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Learn from rows outside the held-out fold.  Reads the texts once.  The prior is estimated unless given."""
    known = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = known.agg(F.sum("quality")).first()[0] or 0
    rows = docs.select("doc_id", "text").where(fold(F.col("doc_id"), 5) != 0)
    plenty = rows.count()
    # The same rows at every run: a part of the hash's range.
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 32)) / float(1 << 32)
    few, many = FIT_ROWS / max(good, 1), 1 - FIT_ROWS / max(plenty, 1)
    # Only rows that may be drawn reach the join.  A trusted positive is web text
    # too: the unlabelled sample takes any row.
    rows = rows.withColumn("drawn", drawn).where((F.col("drawn") < few) | (F.col("drawn") >= many)).join(known, "doc_id", "left")
    is_good = F.coalesce(F.col("quality") == 1, F.lit(False)) & (F.col("drawn") < few)
    parts = F.array_compact(F.array(F.when(is_good, True), F.when(F.col("drawn") >= many, False)))
    rows = rows.select("text", F.explode(parts).alias("positive"))
    got = rows.mapInPandas(_vectors, "positive boolean, x array<float>").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    is_positive = got["positive"].to_numpy().astype(bool)
    positive, unlabelled = x[is_positive], x[~is_positive]
    return fit(positive, unlabelled, class_prior(positive, unlabelled) if prior is None else prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) -> the same rows with ``score``.  No shuffle."""

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            yield pd.Series(model.score(np.stack([features(t) for t in text])) if len(text) else [], dtype="float64")

    return docs.withColumn("score", scores(F.col("text").cast("string")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    held_out = fold(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
