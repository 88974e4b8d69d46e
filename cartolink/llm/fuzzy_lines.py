"""Fuzzy line dedup: of all lines that are nearly the same, one is kept.

Every line has a MinHash signature of its character shingles (one hash of each
shingle deals it to a place, each place keeps its least; empty places borrow from
places that a fixed sequence names).  Lines that agree on all of a band are
candidates; with 16 bands of 7 places, of lines of similarity 0.8 some 97 in 100
pairs are, of similarity 0.9 all but some in 10**5.  All candidates count:
``meeting`` compares them exactly, and lines that reach the threshold are joined by
distributed union-find.  The line that comes first, by document id and place, stays.
Equal lines, the bulk of all repeats, are one node from the start, whatever their
number.

A line is compared without white space at its ends; a line shorter than a shingle
is a shingle.  Blank lines are no lines: they stay and join nothing.  A null text
has no lines.  Rows equal in id and text are one document and get one answer; a
null id comes after all others.  Other columns are carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .meeting import PACKED_SCHEMA, Packer, linked_up, meet, padded, partitions
from .shingles import mixed, tidied
from .staging import Sieve, may_hold, staged

SHINGLE, BANDS, ROWS = 6, 16, 7
NUM, DEN = 80, 100
#: Ids of lines that a worker remembers, so that it gives each line once or little more.
SEEN = 300_000
PRIME = np.uint64(0x100000001B3)
SMALL_PRIME = np.uint32(0x01000193)


def line_id(line: str) -> int:
    h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def lines_of(text: object) -> list[str]:
    return [x.strip() for x in text.split("\n")] if isinstance(text, str) else []


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All lines' characters in a row, where shingles begin, and how many each line has."""
    # Zeros part the lines, enough for a short line to have a shingle.
    joined = "".join(x + "\0" * SHINGLE for x in lines)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(x) for x in lines])
    # A line's shingles end with the line; those that reach into the next part go.
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    inside = np.ones(len(points), bool)
    ends = np.cumsum(sizes + SHINGLE)
    drop = sizes + SHINGLE - counts
    inside[np.repeat(ends - drop, drop) + np.arange(drop.sum()) - np.repeat(np.cumsum(drop) - drop, drop)] = False
    return points, inside[: len(points) - SHINGLE + 1], counts


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each line, in ascending order."""
    if not lines:
        return []
    points, inside, counts = _points(lines)
    n = len(inside)
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h = h * PRIME + points[k : k + n]
    h, ends = mixed(h[inside]), np.cumsum(counts)
    out = []
    for s, e in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        one = np.sort(h[s:e])
        out.append(one[np.append(True, one[1:] != one[:-1])])
    return out


def shingles(line: str) -> np.ndarray:
    return shingle_sets([line])[0]


@cache
def _lenders(places: int, tries: int) -> np.ndarray:
    """The place that each empty place asks at its n-th try."""
    if tries > 4 * places:  # a last resort that ends for certain
        return (np.arange(places) + tries) % places
    return (mixed(np.arange(places, dtype=np.uint64) + np.uint64(tries * 7919)) % np.uint64(places)).astype(np.int64)


def bands(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) keys of the lines' signatures, all lines at once."""
    places = BANDS * ROWS
    points, inside, counts = _points(lines)
    n = len(inside)
    h = points[:n].copy()
    for k in range(1, SHINGLE):
        h *= SMALL_PRIME
        h += points[k : k + n]
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    h = h[inside]
    slot = np.repeat(np.arange(len(lines)) * places, counts)
    slot += ((h >> np.uint32(16)) * np.uint32(places) >> np.uint32(16)).astype(np.int64)
    none = np.uint32(0xFFFFFFFF)
    sig = np.full(len(lines) * places, none)
    np.minimum.at(sig, slot, h)
    sig = sig.reshape(len(lines), places)
    # An empty place borrows from the places of a sequence of its own, the same for all lines.
    own, tries = sig.copy(), 0
    open_ = np.flatnonzero((sig == none).any(1))
    while len(open_):
        tries += 1
        part = sig[open_]
        part = np.where(part == none, own[open_][:, _lenders(places, tries)], part)
        sig[open_] = part
        open_ = open_[(part == none).any(1)]
    parts = sig.reshape(len(lines), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = mixed(keys * PRIME + parts[:, :, k] + np.uint64(1))
    return keys


def _signed(parts: int):
    """For each document its lines' ids (0: blank); packed, the bands of lines new to the task."""

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        packer, turn = Packer(parts), 0
        for batch in batches:
            texts = batch["text"].tolist()
            for first in range(0, len(texts), 64):
                ids, fresh = [], {}
                for text in texts[first : first + 64]:
                    own = []
                    for line in lines_of(text):
                        own.append(h := line_id(line) if line else 0)
                        if line and h not in seen:
                            if len(seen) > SEEN:
                                seen.clear()
                            seen.add(h)
                            fresh[h] = line
                    ids.append(own)
                if fresh:
                    keys = bands(list(fresh.values()))
                    packer.add(keys.ravel(), np.repeat(np.fromiter(fresh, np.int64, len(fresh)), BANDS))
                part = slice(first, first + 64)
                turn += 1  # deals these rows evenly
                spread = (np.arange(len(ids)) + turn * 64) % packer.labels
                yield pd.DataFrame({"part": spread.astype(np.int32), "keys": None, "ids": None, "row": batch["row"][part].to_numpy(), "doc_id": batch["doc_id"][part].astype("Int64").array, "lines": ids})
                if packer.full():
                    yield padded(packer.blocks(), COLUMNS)
        yield padded(packer.blocks(), COLUMNS)

    return run


PAYLOAD = "row long, doc_id long, lines array<long>"
COLUMNS = ["part", "keys", "ids", "row", "doc_id", "lines"]


def _texts(words):
    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            found = [x for text in batch["text"] for x in lines_of(text) if x]
            ids = np.array([line_id(x) for x in found], np.int64)
            rows = []
            for k in np.flatnonzero(may_hold(words.value, ids)).tolist():
                if (h := int(ids[k])) not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(h)
                    rows.append((h, found[k]))
            yield pd.DataFrame(rows, columns=["node", "x"]).astype({"node": "int64", "x": "object"})

    return run


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, x): the texts of the lines whose ids are ``wanted``, once each, and of few others."""
    wanted = staged(wanted, "fl-wanted")
    shared = docs.sparkSession.sparkContext.broadcast(Sieve(wanted, "node").words)
    found = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(_texts(shared), "node long, x string")
    return found.groupBy("node").agg(F.first("x").alias("x"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (row, dropped): places of the lines that go, for each document that loses any.

    ``row`` is ``row_key`` of the document.
    """
    read = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = partitions(read)
    signed = staged(meet(read.mapInPandas(_signed(parts), f"{PACKED_SCHEMA}, {PAYLOAD}"), parts, PAYLOAD), "fl-signed")
    roots = linked_up(signed.where("bucket is not null").select("bucket", "a", "b"), lambda wanted: line_texts(docs, wanted), shingle_sets, NUM, DEN)

    # Where each line occurs, and the first place of its component.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at")
    occurs = signed.where("bucket is null").select("row", "doc_id", F.posexplode("lines").alias("at", "line")).where("line <> 0")
    first = occurs.groupBy("line").agg(F.min(place).alias("place"), F.count("*").alias("times"))
    first = first.join(roots.withColumnRenamed("node", "line"), "line", "left")
    first = staged(first.where("root is not null or times > 1").select("line", "root", "place"), "fl-first")
    several = first.where("root is not null")
    kept = staged(several.groupBy("root").agg(F.min("place").alias("kept")), "fl-kept")
    first = several.join(kept, "root").select("line", "kept").unionByName(first.where("root is null").select("line", F.col("place").alias("kept")))
    gone = occurs.join(first, "line").where(place != F.col("kept"))
    return gone.groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("dropped"))


def row_key():
    """Equal for rows of one id and text, and for no others (to 64 bits)."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), F.col("text").cast("string"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``text`` rewritten, ``n_lines`` and ``n_removed``.

    ``n_lines`` counts lines that are not blank.  Only rows that may lose lines are shuffled,
    and merged at any size.
    """
    dropped = staged(repeated(docs), "fl-dropped").select(F.col("row").alias("_fl_row"), F.col("dropped").alias("_fl_dropped"))
    rows = docs.withColumn("_fl_row", row_key())
    may = Sieve(dropped, "_fl_row").may(F.col("_fl_row"))
    none = F.lit(None).cast("array<int>").alias("_fl_dropped")
    rows = rows.where(~may).select("*", none).unionByName(rows.where(may).join(dropped.hint("merge"), "_fl_row", "left")).drop("_fl_row")
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    left = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(F.col("_fl_dropped"), s["i"]))
    text = F.when(F.col("_fl_dropped").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda s: s["x"]), "\n"))
    full = F.size(F.filter(lines, lambda x: F.rlike(x, F.lit(r"(?U)[^\s\x1c-\x1f]"))))
    rows = rows.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(full).cast("long"))
    rows = rows.withColumn("n_removed", F.coalesce(F.size("_fl_dropped"), F.lit(0)).cast("long"))
    return rows.withColumn("text", text).drop("_fl_dropped")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, text for every row of ``docs``."""
    return dedup(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")
