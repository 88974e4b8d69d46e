"""Document fingerprints by consistent weighted sampling.

A text is a bag of weighted terms: its words and how often each occurs.  For each
of ``SAMPLES`` places, every term draws two gamma variates and a uniform one from
a generator that only the term and the place seed; they give the term's weight a
quantised level and a hash value, and the term with the least value is sampled
with its level.  Two texts agree at a place with the probability of their
generalised Jaccard similarity, the sum of the lesser over the sum of the greater
weights.

Null and blank texts have an empty fingerprint; two such are alike (1), one such
and another text are not (0).  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .meeting import partitions

SAMPLES = 64
#: Terms whose draws a worker keeps at once, and documents that it works on together.
KEPT_TERMS, TOGETHER = 60_000, 128
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _gamma(bits: int) -> np.ndarray:
    """Quantiles of gamma(2, 1) at the middles of ``2 ** bits`` equal parts."""
    x = np.concatenate([np.geomspace(1e-5, 1, 20_000), np.linspace(1, 30, 20_000)[1:]])
    return np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), -np.expm1(-x) - x * np.exp(-x), x).astype(np.float32)


@cache
def _log_gamma(bits: int) -> np.ndarray:
    return np.log(_gamma(bits))


class Sampler:
    def __init__(self, samples: int = SAMPLES, kept: int = KEPT_TERMS):
        self.samples, self.kept = samples, kept
        self.row: dict[bytes, int] = {}
        self.hash = np.zeros(0, np.uint64)
        self.rate = self.value = self.shift = self.once = np.zeros((0, samples), np.float32)

    def _learn(self, bags: list[Counter]) -> None:
        new = list(dict.fromkeys(t for bag in bags for t in bag if t not in self.row))
        if len(self.row) + len(new) > self.kept:
            self.row.clear()
            new = list(dict.fromkeys(t for bag in bags for t in bag))
            self.__init__(self.samples, self.kept)
        if not new:
            return
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
        h = np.array([xxhash.xxh64_intdigest(t) for t in new], np.uint64)
        place = np.arange(self.samples, dtype=np.uint64)

        # One generator's 64 bits hold all three draws.
        bits = _mixed(h[:, None] + (place + np.uint64(1))[None] * GOLDEN)
        rate = _gamma(16)[(bits >> np.uint64(48)).astype(np.int32)]
        value = _log_gamma(20)[(bits >> np.uint64(28)).astype(np.int32) & 0xFFFFF]
        shift = ((bits & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)
        once = value - rate * (1 - shift)  # of a term that occurs once: its level is 0
        grown = lambda a, b: np.concatenate([a, b])
        self.hash = grown(self.hash, h)
        self.rate, self.value, self.shift, self.once = (grown(a, b) for a, b in ((self.rate, rate), (self.value, value), (self.shift, shift), (self.once, once)))

    def fingerprints(self, bags: list[Counter]) -> list[str]:
        self._learn(bags)
        out = []
        for bag in bags:
            if not bag:
                out.append("")
                continue
            rows = np.fromiter((self.row[t] for t in bag), np.int64, len(bag))
            times = np.fromiter(bag.values(), np.int64, len(bag))
            single, more = rows[times == 1], rows[times > 1]
            level = np.floor(np.log(times[times > 1].astype(np.float32))[:, None] / self.rate[more] + self.shift[more])
            cost = np.concatenate([self.once[single], self.value[more] - self.rate[more] * (level - self.shift[more] + 1)])
            best = cost.argmin(0)
            term = np.concatenate([single, more])[best]
            at = np.arange(self.samples)
            levels = np.concatenate([np.zeros((len(single), self.samples), np.float32), level])[best, at] if len(more) else np.zeros(self.samples)
            codes = _mixed(self.hash[term] + levels.astype(np.int64).astype(np.uint64) * GOLDEN) >> np.uint64(48)
            out.append(codes.astype(">u2").tobytes().hex())
        return out


def likeness(a: str, b: str) -> float:
    """Share of places at which two fingerprints agree."""
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)


def bag_of(text: str) -> Counter:
    return Counter(text.encode("utf-8", "surrogatepass").split())


@cache
def _sampler() -> Sampler:
    return Sampler()


def fingerprints(docs: DataFrame) -> DataFrame:
    """The rows with a column ``fingerprint`` of ``text``; no shuffle."""

    @F.pandas_udf("string")
    def column(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            bags = [bag_of(t) if isinstance(t, str) else Counter() for t in part]
            yield pd.Series([f for i in range(0, len(bags), TOGETHER) for f in _sampler().fingerprints(bags[i : i + TOGETHER])], dtype="object")

    return docs.withColumn("fingerprint", column(F.col("text").cast("string")))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in ranges of ascending doc_id: columns target, ahead, doc_id, text.

    A range's partition holds its rows in order and then, with ``ahead`` set, the
    rows that come next in the whole table (after the last, the first).  Every
    text is shuffled once.  Null ids come last; rows of one id are ordered by text.
    """
    from pyspark.ml.feature import Bucketizer

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "coalesce(cast(text as string), '') text")
    # Both grow with the texts; many ranges a partition, so that none gets far more than its share.
    parts = partitions(rows)
    ranges = 12 * parts
    edges = rows.select(F.col("doc_id").cast("double").alias("at")).approxQuantile("at", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [-float("inf"), *(sorted(set(edges)) or [0.0]), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="at", outputCol="range", handleInvalid="keep")
    cut_up = lambda df: cut.transform(df.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))))).drop("at")
    # One row a range: at most ``ranges`` + 1 of them.
    firsts = cut_up(rows.select("doc_id")).groupBy("range").agg(F.min("doc_id").alias("first")).orderBy("range").collect()
    before = [(float(row["range"]), row["first"], float(firsts[k - 1]["range"])) for k, row in enumerate(firsts)]
    first = docs.sparkSession.createDataFrame(before, "range double, first bigint, before double")
    rows = cut_up(rows).join(F.broadcast(first), "range", "left")
    both = F.array(F.struct(F.col("range").alias("target"), F.lit(0).alias("ahead")), F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.struct(F.col("before").alias("target"), F.lit(1).alias("ahead"))))
    rows = rows.select(F.explode(F.array_compact(both)).alias("to"), "doc_id", "text").select("to.target", "to.ahead", "doc_id", "text")
    return rows.repartition(parts, "target").sortWithinPartitions("target", "ahead", F.asc_nulls_last("doc_id"), "text")


def _edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sampler = _sampler()
    held = None  # target, doc_id, text and fingerprint of the row whose next is still to come
    for batch in batches:
        ids = [None if i is None or i != i else int(i) for i in batch["doc_id"].tolist()]
        for at in range(0, len(ids), TOGETHER):
            part, pairs = slice(at, at + TOGETHER), []
            rows = list(zip(batch["target"][part], batch["ahead"][part], ids[part], batch["text"][part], strict=True))
            own = sampler.fingerprints([bag_of(text) for *_, text in rows])
            for (target, ahead, doc_id, text), print_ in zip(rows, own, strict=True):
                if held is not None and held[0] == target:
                    half = len(held[2]) // 2
                    pairs.append((*held[1:], held[2][: len(held[2]) - half] + text[:half], print_))
                held = None if ahead else (target, doc_id, text, print_)
            prints = sampler.fingerprints([bag_of(edited) for *_, edited, _ in pairs])
            made = []
            for (doc_id, text, mine, edited, following), changed in zip(pairs, prints, strict=True):
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                made.append((doc_id, len(text), digest, mine, changed, likeness(mine, changed), likeness(mine, following)))
            got = pd.DataFrame(made, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            yield got.assign(doc_id=pd.array(got["doc_id"].tolist(), dtype="Int64"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half replaced by the beginning of
    the next document's.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInPandas(_edits, schema)
