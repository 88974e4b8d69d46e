"""Exact Jaccard similarity join of word-shingle sets by PartEnum signatures.

Sets of sizes s and t that are similar enough differ in at most ``h = (s + t) *
(1 - j) / (1 + j)`` elements.  Sets of a band of sizes cut the domain of shingle
hashes into the same parts, more than ``h / 2`` of them: so two similar sets differ
in at most one element in at least one part.  A part is cut again, into ``SUBS``
smaller ones, of which the sets then agree on all but one.  A set enumerates, for
each part, the subsets that leave out one of its smaller parts; what it holds in
such a subset is a signature.  A set need enumerate only as many parts as its own
size allows partners to differ in; it does so in its own band and, where a partner
may be there, in the next.  Empty subsets say little: ``spare`` further parts make
up for as many parts with one, and only a set with more of these lists empty ones
too.  So no link is lost.

Signatures lead to links as ``meeting`` says: members of a bucket are compared, by
their whole shingle sets, until no two that are not yet connected could link.

Equal sets are joined by a digest first and only the least id of a task's equal
sets lists signatures.  A document without words links with nothing.  Rows that
share an id are one node; rows with a null id link with nothing and have a null
component.  Very long texts have as many signatures as their size asks for.  Other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .meeting import PACKED_SCHEMA, Packer, linked_up, meet, padded, partitions
from .shingles import mixed, shingle_set, tidied
from .staging import Sieve, staged

#: Ratio of a band's ends, and smaller parts in a part.
BAND, SUBS = 1.5, 3


class Plan:
    """Bands, parts and bounds for one threshold, ``num / den``."""

    def __init__(self, num: int = 85, den: int = 100):
        self.num, self.den = num, den
        self.loss = Fraction(den - num, den + num)
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))

    def differ(self, s: int, t: int) -> int:
        """The most elements in which linked sets of these sizes differ."""
        return (s + t) * self.loss.numerator // self.loss.denominator

    def largest(self, s: int) -> int:
        """The largest size of a set that links with one of size s."""
        return s * self.den // self.num

    @cache  # noqa: B019
    def band(self, b: int) -> tuple[int, int]:
        """(parts, spare) of band ``b``."""
        low, high = self.edges[b], self.edges[b + 1] - 1
        most = self.differ(high, high) // 2 + 1
        smallest = max(1, low * self.num // self.den)
        # Parts with an empty subset, as many as may be expected and half as many more.
        spare = int(1.5 * most * SUBS * np.exp(-smallest / most * (SUBS - 1) / SUBS)) + 2
        return most + spare, spare

    def groups(self, s: int) -> Iterator[tuple[int, int, int, int]]:
        """(band, parts, parts to enumerate, spare) for a set of size s."""
        own, top = bisect_right(self.edges, s) - 1, self.largest(s)
        for b in (own, own + 1):
            if b > own and top < self.edges[b]:
                return
            partner = min(self.edges[b + 1] - 1, top)
            h = self.differ(s, partner)
            parts, spare = self.band(b)
            if h:  # else only equal sets link
                yield b, parts, min(parts, h // 2 + 1 + spare), spare

    def signatures(self, x: np.ndarray) -> np.ndarray:
        """Of a set of hashes in ascending order."""
        out = [np.zeros(0, np.uint64)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(x + np.uint64(0x51)), dtype=np.uint64)])
        high = (x >> np.uint64(32)).astype(np.int64)
        for b, parts, shown, spare in self.groups(len(x)):
            ends = np.searchsorted(high, -(-(np.arange(shown * SUBS + 1, dtype=np.int64) << 32) // (parts * SUBS)))
            held = (ends[1:] - ends[:-1]).reshape(shown, SUBS)
            small = (sums[ends[1:]] - sums[ends[:-1]]).reshape(shown, SUBS)
            named = np.arange(shown * SUBS, dtype=np.uint64).reshape(shown, SUBS) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((b + 1) * 0xD1342543DE82EF95 % (1 << 64))
            sig = mixed(mixed(small.sum(1, dtype=np.uint64)[:, None] - small) + named)
            empty = held.sum(1)[:, None] == held
            out.append(sig.ravel() if empty.any(1).sum() > spare else sig[~empty])
        return np.concatenate(out)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.den * min(len(a), len(b)) < self.num * max(len(a), len(b)) or not len(a):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)


COLUMNS = ["part", "keys", "ids", "doc_id", "n", "digest"]
PAYLOAD = "doc_id long, n long, digest binary"


def _signed(plan: Plan, n: int, parts: int):
    """Size and digest of each document's set; packed, the signatures of sets new to the task."""

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: set[bytes] = set()
        packer, turn = Packer(parts), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                x = shingle_set(text, n)
                known = not (doc_id is None or doc_id != doc_id)
                digest = xxhash.xxh3_128_digest(x.tobytes())
                if known and len(x) and digest not in first:
                    if len(first) > 200_000:
                        first.clear()
                    first.add(digest)
                    sig = plan.signatures(x)
                    packer.add(sig, np.full(len(sig), int(doc_id), np.int64))
                    if packer.full():
                        yield padded(packer.blocks(), COLUMNS)
                turn += 1  # deals these rows evenly
                rows.append((turn % packer.labels, None, None, int(doc_id) if known else None, len(x), digest))
            got = pd.DataFrame(rows, columns=COLUMNS)
            yield got.assign(doc_id=got["doc_id"].astype("Int64"), part=got["part"].astype("int32"))
        yield padded(packer.blocks(), COLUMNS)

    return run


def jaccard_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id for every row of ``docs``."""
    plan = Plan(num, den)
    read = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    parts = partitions(read)
    signed = staged(meet(read.mapInPandas(_signed(plan, n, parts), f"{PACKED_SCHEMA}, {PAYLOAD}"), parts, PAYLOAD), "pe-signed")
    sets = signed.where("bucket is null").select("doc_id", "n", "digest")
    same = sets.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("a"), F.count("*").alias("copies")).where("copies > 1")
    same = staged(same, "pe-same")  # the join can then be split where many texts are equal
    equal = sets.select("doc_id", "digest").join(same, "digest").where("a <> doc_id").select("a", F.col("doc_id").alias("b"))

    def contents(wanted: DataFrame) -> DataFrame:
        """The texts that share a signature, and few others."""
        wanted = staged(wanted.select(F.xxhash64("node").alias("key")), "pe-wanted")
        return read.select(F.col("doc_id").alias("node"), F.col("text").alias("x")).where(Sieve(wanted, "key").may(F.xxhash64("node")))

    sets_of = lambda texts: [shingle_set(x, n) for x in texts]
    roots = linked_up(signed.where("bucket is not null").select("bucket", "a", "b"), contents, sets_of, num, den, known=equal, packed=True)
    out = sets.select("doc_id", F.col("n").alias("n_shingles"))
    # Ids that are null meet nothing and stay out of the shuffle.
    placed = out.where("doc_id is not null").join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = placed.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return placed.unionByName(out.where("doc_id is null").withColumn("component_id", F.lit(None).cast("long")))
