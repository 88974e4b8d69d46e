"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed, a run of ``SEED`` tokens, are
compared.  Tiling marks the longest run of tokens that both have and neither has
marked, again and again, down to the seed's length; runs are found by comparing
Karp-Rabin hashes of all windows of one length, which halves from pass to pass.
The share of an item's tokens that tiles cover does not depend on their order, so
a passage whose parts were moved about counts in full.

The benchmark is the query set: it is taken in blocks of bounded size, each sent
to all tasks, and every block meets all documents in one pass without a shuffle.
A pair is tiled only if the seeds it shares could reach the threshold; that is a
bound, not an estimate, as every tile consists of shared seeds.

Tokens are the runs of letters, digits and underscores, lower-cased.  An item
with fewer tokens than a seed has is a seed itself.  Null and empty texts and
items match nothing; ids are carried as they are, equal or null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mixed, windows, word_hashes

SEED, COVERAGE = 5, 0.6
#: Tokens of benchmark items in a block, about.
BLOCK_TOKENS = 4_000_000
TOKEN = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def tokens(text: object) -> np.ndarray:
    return word_hashes([t.encode("utf-8", "surrogatepass") for t in TOKEN.findall(text.lower())]) if isinstance(text, str) else np.zeros(0, np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n - 1, 0), base, np.uint64), dtype=np.uint64)])[:n]


def rolling(x: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``size``, from one running sum."""
    if len(x) < size:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(BASE, len(x)), dtype=np.uint64)])
    return (sums[size:] - sums[:-size]) * _powers(INVERSE, len(x) - size + 1)


#: Places of one hash in a text from which on they are compared all at once.
MANY = 16


def _at_once(item: np.ndarray, text: np.ndarray, taken_item: np.ndarray, taken_text: np.ndarray, i: int, js: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(length, i, j) of the matches of ``size`` or more that begin at i and one of ``js``, where a text repeats itself."""
    begins = item[i] == text[js]
    if i and not taken_item[i - 1]:
        begins &= ~((js > 0) & ~taken_text[js - 1] & (item[i - 1] == text[js - 1]))
    js = js[begins]
    lengths, going, n = np.zeros(len(js), int), np.arange(len(js)), 0
    while len(going) and not taken_item[i + n]:
        at = js[going] + n
        free = ~taken_text[at]
        going = going[free][item[i + n] == text[at[free]]]
        n += 1
        lengths[going] = n
    return [(int(n), i, int(j)) for n, j in zip(lengths, js, strict=True) if n >= size]


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in item, start in text, length) of the tiles, longest first in each pass."""
    taken_item, taken_text = np.zeros(len(item) + 1, bool), np.zeros(len(text) + 1, bool)
    taken_item[-1] = taken_text[-1] = True
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(text)))
    free = lambda taken, n: np.flatnonzero(np.convolve(taken[:-1], np.ones(n, int), "valid") == 0) if len(taken) > n else np.zeros(0, int)
    while size >= least:
        at_item, at_text = free(taken_item, size), free(taken_text, size)
        h_item, h_text = rolling(item, size)[at_item], rolling(text, size)[at_text]
        order = np.argsort(h_text, kind="stable")
        low, high = np.searchsorted(h_text[order], h_item, "left"), np.searchsorted(h_text[order], h_item, "right")
        matches = []
        for k in np.flatnonzero(high > low):
            i, js = int(at_item[k]), at_text[order[low[k] : high[k]]]
            if len(js) > MANY:
                matches += _at_once(item, text, taken_item, taken_text, i, js, size)
                continue
            for j in js.tolist():
                if (i and j and not taken_item[i - 1] and not taken_text[j - 1] and item[i - 1] == text[j - 1]) or item[i] != text[j]:
                    continue  # a part of the match that begins before it
                n = 0
                while not taken_item[i + n] and not taken_text[j + n] and item[i + n] == text[j + n]:
                    n += 1
                if n >= size:
                    matches.append((n, i, j))
        for n, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if not taken_item[i : i + n].any() and not taken_text[j : j + n].any():
                taken_item[i : i + n] = taken_text[j : j + n] = True
                found.append((i, j, n))
        if size == least:
            # What an overlap cut short may still hold shorter tiles.
            if not matches:
                break
        else:
            size = max(least, size // 2)
    return found


@dataclass
class Block:
    ids: list
    items: list[np.ndarray]
    seeds: np.ndarray  #: sorted, each with the item and the place it is from
    item: np.ndarray
    place: np.ndarray
    short: bool  #: some item has fewer tokens than a seed


def _block(rows: list[tuple[object, np.ndarray]]) -> Block:
    seeds = [windows(x, SEED) for _, x in rows]
    joined = np.concatenate([*seeds, np.zeros(0, np.uint64)])
    order = np.argsort(joined, kind="stable")
    item = np.repeat(np.arange(len(rows)), [len(s) for s in seeds])
    place = np.concatenate([*(np.arange(len(s)) for s in seeds), np.zeros(0, int)])
    return Block([i for i, _ in rows], [x for _, x in rows], joined[order], item[order], place[order], any(len(x) < SEED for _, x in rows))


def blocks(benchmark: DataFrame, most: int = BLOCK_TOKENS) -> Iterator[Block]:
    """The benchmark's items, read one after another, in blocks of bounded size."""
    rows, size = [], 0
    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        x = tokens(row["text"])
        if len(x):
            rows.append((row["item_id"], x))
            size += len(x)
        if size >= most:
            yield _block(rows)
            rows, size = [], 0
    if rows:
        yield _block(rows)


def matches(block: Block, x: np.ndarray, coverage: float) -> Iterator[tuple[int, int, int]]:
    """(item, covered tokens, tiles) of the items that a document's tokens hold."""
    sizes = {SEED} | ({*range(1, SEED)} if block.short else set())
    pool = np.unique(np.concatenate([windows(x, n) for n in sizes]))
    low, high = np.searchsorted(block.seeds, pool, "left"), np.searchsorted(block.seeds, pool, "right")
    which = np.flatnonzero(high > low)
    hit = np.concatenate([np.zeros(0, int), *(np.arange(low[k], high[k]) for k in which)])
    if not len(hit):
        return
    for k in np.unique(block.item[hit]).tolist():
        item = block.items[k]
        size = min(SEED, len(item))
        covered = np.zeros(len(item), bool)
        for p in block.place[hit[block.item[hit] == k]].tolist():
            covered[p : p + size] = True
        if covered.sum() < coverage * len(item):
            continue
        # Only stretches of the document made of the item's seeds can hold tiles.
        inside = np.isin(windows(x, size), windows(item, size))
        keep = np.zeros(len(x), bool)
        for p in np.flatnonzero(inside).tolist():
            keep[p : p + size] = True
        edges = np.flatnonzero(np.diff(keep, prepend=False, append=False))
        parts = []
        for n, (a, b) in enumerate(zip(edges[::2], edges[1::2], strict=True)):
            parts += [x[a:b], mixed(np.array([n + 1], np.uint64))]  # a divider that no token equals
        laid = tiles(item, np.concatenate(parts), size)
        marked = sum(n for _, _, n in laid)
        if marked >= coverage * len(item):
            yield k, marked, len(laid)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, coverage, tiles) of the pairs that reach ``coverage``."""
    read = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    schema = "doc_id long, item_id long, item_tokens long, covered_tokens long, coverage double, tiles long"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark.selectExpr("cast(item_id as bigint) item_id", "text")):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            here = shared.value
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                    doc_id = None if doc_id is None or doc_id != doc_id else int(doc_id)
                    x = tokens(text)
                    for k, covered, n in matches(here, x, coverage) if len(x) else ():
                        size = len(here.items[k])
                        rows.append((doc_id, here.ids[k], size, covered, covered / size, n))
                got = pd.DataFrame(rows, columns=["doc_id", "item_id", "item_tokens", "covered_tokens", "coverage", "tiles"])
                yield got.assign(doc_id=pd.array(got["doc_id"].tolist(), dtype="Int64"), item_id=pd.array(got["item_id"].tolist(), dtype="Int64"))

        found = found.unionByName(read.mapInPandas(run, schema))
    return found
