"""The nearest of many exemplars by several hashes at once: numpy code behind Arrow.

Weighted differing bits of all pairs are one matrix product, which decides only what can't be
among the best; similarities of the rest are counted bit by bit, in the order of operations of
``bits.weighted_similarity``, so that equal ones are equal to the last digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bits import HASH_WEIGHTS

KINDS = tuple(HASH_WEIGHTS)
#: Weights as whole numbers: products of them are exact.
HUNDREDTHS = {c: round(100 * w) for c, w in HASH_WEIGHTS.items()}
#: Queries and exemplars of one product, and pairs that wait to be ranked.
QUERY_ROWS, ROWS, WAITING = 512, 1024, 1 << 20

Group = tuple[tuple[int, ...], np.ndarray, list[np.ndarray]]


def groups(table: pa.Table) -> list[Group]:
    """Rows by the lengths of their hashes (-1: null, or with a null word): lengths, places of rows, words of each kind."""
    lengths, parts = [], []
    for c in KINDS:
        lists = table.column(c).combine_chunks()
        length = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, values = lists.offsets.to_numpy()[:-1].astype(np.int64), lists.values
        if values.null_count:
            ends = np.cumsum(np.concatenate([[0], values.is_null().to_numpy(zero_copy_only=False)]))
            length = np.where(ends[starts + np.maximum(length, 0)] > ends[starts], -1, length)
        lengths.append(length)
        parts.append((starts, pc.fill_null(values, 0).to_numpy(zero_copy_only=False).view(np.uint64)))
    if not table.num_rows:
        return []
    kinds, of = np.unique(np.stack(lengths, axis=1), axis=0, return_inverse=True)
    out = []
    for n, lens in enumerate(kinds):
        rows = np.flatnonzero(of.ravel() == n)
        out.append((tuple(lens.tolist()), rows, [words[starts[rows][:, None] + np.arange(max(size, 0))] for (starts, words), size in zip(parts, lens, strict=True)]))
    return out


def signs(words: list[np.ndarray], scales: list[int], kind: type) -> np.ndarray:
    """Bits as plus and minus the scale of their hash."""
    bits = [np.unpackbits(np.ascontiguousarray(w).view(np.uint8), axis=1).astype(kind) * (2 * s) - s if w.shape[1] else np.zeros((len(w), 0), kind) for w, s in zip(words, scales, strict=True)]
    return np.concatenate(bits, axis=1)


class Best:
    """The ``k`` exemplars of most similarity of each query, ties by lesser id, while exemplars stream by.

    Queries have ``q_id``, exemplars ``d_id`` and any columns in ``carried``; both have the hashes of
    ``KINDS`` and ``skip``: pairs equal in it (null: none) are left out.  Pairs without a hash in
    common are left out too.
    """

    def __init__(self, queries: pa.Table, k: int, bits: int, carried: list[str]):
        self.k, self.bits, self.carried = k, bits, carried
        self.ids, self.groups = queries.column("q_id").combine_chunks(), groups(queries)
        skip = queries.column("skip").combine_chunks()
        self.skips = pc.drop_null(pc.unique(skip))
        self.codes = self.coded(skip)
        self.sims = np.full((queries.num_rows, k), -np.inf)
        self.rows, self.near = (np.full((queries.num_rows, k), -1) for _ in range(2))
        self.pool: pa.Table | None = None

    def coded(self, skip: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(skip, self.skips.cast(skip.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, batch: pa.Table) -> None:
        codes, waiting, n = self.coded(batch.column("skip").combine_chunks()), [], 0
        for group in groups(batch):
            group = self.without_copies(group, codes, batch)
            for found in self.compared(group, codes):
                waiting.append(found)
                n += len(found[0])
                if n > WAITING:
                    self.merge(waiting, batch)
                    waiting, n = [], 0
        if n:
            self.merge(waiting, batch)

    def without_copies(self, group: Group, codes: np.ndarray, batch: pa.Table) -> Group:
        """Of rows equal in all hashes the ``k`` of least id can be among the best, and rows that a query skips are kept beside these."""
        lens, rows, words = group
        key = np.ascontiguousarray(np.concatenate(words, axis=1))
        if not key.shape[1]:
            of = np.zeros(len(rows), np.int64)
        else:
            of = np.unique(key.view(f"V{8 * key.shape[1]}").ravel(), return_inverse=True)[1].ravel()
        free = np.flatnonzero(codes[rows] < 0)
        order = free[np.lexsort((ranks(batch.column("d_id"))[rows[free]], of[free]))]
        kept = np.sort(np.concatenate([np.flatnonzero(codes[rows] >= 0), order[places(of[order]) < self.k]]))
        return lens, rows[kept], [w[kept] for w in words]

    def compared(self, group: Group, codes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query, row of the batch, similarity, differing bits of the first kind or -1) of pairs that may be among the best."""
        lens, rows, words = group
        for q_lens, q_rows, q_words in self.groups:
            common = [n for n in range(len(KINDS)) if q_lens[n] == lens[n] >= 0]
            if not common:
                continue
            scales = [HUNDREDTHS[KINDS[n]] for n in common]
            most = sum(64 * lens[n] * s for n, s in zip(common, scales, strict=True))
            kind = np.float32 if most < 1 << 24 else np.float64
            d = signs([words[n] for n in common], [1] * len(common), kind)
            for at in range(0, len(q_rows), QUERY_ROWS):
                mine = q_rows[at : at + QUERY_ROWS]
                q = signs([q_words[n][at : at + QUERY_ROWS] for n in common], scales, kind)
                # A product is ``most`` less twice the weighted bits; one of them is five at least, so 1 is slack.
                least = np.maximum(most - 2 * (1 - self.sims[mine, -1]) * self.bits * sum(scales) - 1, -1e30)
                for first in range(0, len(rows), ROWS):
                    part = rows[first : first + ROWS]
                    product = q @ d[first : first + ROWS].T
                    if len(named := np.flatnonzero(codes[part] >= 0)):
                        some = product[:, named]
                        some[self.codes[mine][:, None] == codes[part][named]] = -np.inf
                        product[:, named] = some
                    good = product >= least[:, None]
                    if len(part) > self.k and np.count_nonzero(good) > 4 * self.k * len(mine):
                        least = np.maximum(least, np.partition(product, len(part) - self.k, axis=1)[:, len(part) - self.k])
                        good = product >= least[:, None]
                    a, b = np.nonzero(good)
                    if len(a):
                        yield mine[a], part[b], *self.similar([w[at + a] for w in q_words], [w[first + b] for w in words], common)

    def similar(self, q: list[np.ndarray], d: list[np.ndarray], common: list[int]) -> tuple[np.ndarray, np.ndarray]:
        total, weight, near = np.zeros(len(q[0])), 0.0, np.full(len(q[0]), -1)
        for n in common:
            differing = np.bitwise_count(q[n] ^ d[n]).sum(axis=1, dtype=np.int64)
            total, weight = total + HASH_WEIGHTS[KINDS[n]] * differing / self.bits, weight + HASH_WEIGHTS[KINDS[n]]
            near = differing if n == 0 else near
        return 1 - total / weight, near

    def merge(self, waiting: list[tuple[np.ndarray, ...]], batch: pa.Table) -> None:
        """The best of those kept and those that wait; only exemplars that are among them stay in memory."""
        batch = batch.select(self.carried)
        known = 0 if self.pool is None else self.pool.num_rows
        table = batch if self.pool is None else pa.concat_tables([self.pool, batch])
        old = np.nonzero(self.rows >= 0)
        q, row, sim, near = (np.concatenate(c) for c in zip((old[0], self.rows[old], self.sims[old], self.near[old]), *[(a, b + known, s, n) for a, b, s, n in waiting], strict=True))
        order = np.lexsort((ranks(table.column("d_id"))[row], -sim, q))
        place = places(q[order])
        order, place = order[place < self.k], place[place < self.k]
        used, of = np.unique(row[order], return_inverse=True)
        self.pool = table.take(pa.array(used)).combine_chunks()
        at = q[order], place
        self.sims[at], self.rows[at], self.near[at] = sim[order], of.ravel(), near[order]

    def found(self) -> pa.Table | None:
        """q_id, the carried columns, sim, bits."""
        if self.pool is None:
            return None
        at = np.nonzero(self.rows >= 0)
        pool, near = self.pool.take(pa.array(self.rows[at])), self.near[at]
        return pa.table([self.ids.take(pa.array(at[0])), *pool.columns, pa.array(self.sims[at]), pa.array(near.astype(np.int32), mask=near < 0)], ["q_id", *pool.column_names, "sim", "bits"])


def ranks(ids: pa.ChunkedArray) -> np.ndarray:
    """Places in ascending order, null first, equal ids alike."""
    return pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)


def places(keys: np.ndarray) -> np.ndarray:
    """The place of each row among those of its key; keys are sorted."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
