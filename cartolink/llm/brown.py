"""Language-model scores from a Brown class-based bigram model.

Words are the maximal runs of non-blank characters, A-Z lower-cased; a text ends
with an end token.  Every word that occurs ``LEAST`` times or more is put into a
class by the exchange algorithm, which moves a word to the class that most raises
the likelihood of the class bigrams.  The ``SEEDS`` most frequent words are moved
one at a time, to start from; then all words move at once, each against the class
bigrams with itself taken out, for up to ``PASSES`` passes, of which the last counts
that raised the likelihood.  Rarer words have the class of their shape.  A text's
score is the sum over its tokens of the log10 probability of the token's class after
the class before it, smoothed towards the class's own frequency, and of the token
given its class, smoothed by adding ``ADD``.

Counts cover every training text.  Word bigrams stay in a table, all of a word in one
row of ranges of words, so a pass reads it and shuffles nothing.  The clustered words' keys, counts and classes (some 34 bytes a word)
come to the driver and are sent to all tasks: they grow as the words that occur
``LEAST`` times do, which is slower than the text.  All other words' counts meet
their occurrences in a join.

Null and empty texts consist of the end token.  Rows are scored one by one, so
equal or null ids do no harm.  With no training text every count is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .meeting import partitions
from .shingles import tidied
from .staging import staged

#: Occurrences of a word that is put into a class.
LEAST = 10
#: Words to start from, classes, rounds over the words to start from and passes over all.
SEEDS, CLASSES, ROUNDS, PASSES = 1_500, 48, 4, 3
#: Word bigrams that a worker keeps at once, words moved at once, and classes tried for each.
BIGRAMS, MOVED, TRIED = 1_000_000, 512, 3
#: Ranges of words for each partition.
RANGES = 12
ADD = 0.1
#: Weight of a class's own frequency in its probability after another class.
BACK = 20.0
SHAPES = 8
#: Distinct words that a worker keeps at once.
KEPT = 200_000
END = b"\n"  # no word holds it


def key(word: bytes) -> int:
    """A signed 64-bit key."""
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


END_KEY = key(END)


DIGIT = re.compile(rb"[0-9]").search


def shape(word: bytes) -> int:
    """What an infrequent word looks like: digits, a mark at its end, marks inside, or its length."""
    if word.isalpha():
        return 6 + (len(word) > 8)
    if DIGIT(word):
        return 0
    if word[-1] < 128 and not word[-1:].isalpha():
        return 1 if word[-1] in b".!?" else 2
    return 3 if word.isascii() else 4 + (len(word) > 8)


def hashes(found: list[bytes]) -> np.ndarray:
    """``key`` of each."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)


def words(text: object) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


@tidied
def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a part of the rows; a word comes once for each ``KEPT`` distinct ones."""
    seen, ends = Counter(), 0

    def out() -> pd.DataFrame:
        return pd.DataFrame({"h": hashes(list(seen)), "shape": np.fromiter(map(shape, seen), np.int64, len(seen)), "n": np.fromiter(seen.values(), np.int64, len(seen))})

    for batch in batches:
        for text in batch["text"]:
            seen.update(words(text))
            ends += 1
            if len(seen) >= KEPT:
                yield out()
                seen = Counter()
    if seen:
        yield out()
    if ends:
        yield pd.DataFrame({"h": [END_KEY], "shape": [-1], "n": [ends]})


def count_words(train: DataFrame) -> DataFrame:
    """(text) -> h, shape, c: every training token's count, with the end token (shape -1)."""
    parts = train.select("text").mapInPandas(_word_counts, "h long, shape long, n long")
    return parts.groupBy("h").agg(F.max("shape").alias("shape"), F.sum("n").alias("c"))


class _Codes(dict):
    """Word -> its place in the head, or below 0 for a place among the tail words seen."""

    def __init__(self, head: np.ndarray):
        self.head, self.tail = head, []
        self.shapes = np.zeros(1024, np.int64)  # of the tail

    def _learn(self, new: list[bytes]) -> None:
        h = hashes(new)
        at = np.searchsorted(self.head, h)
        known = self.head[np.minimum(at, len(self.head) - 1)] == h if len(self.head) else np.zeros(len(h), bool)
        beyond, first = np.flatnonzero(~known), len(self.tail)
        at[beyond] = -1 - first - np.arange(len(beyond))
        self.tail += h[beyond].tolist()
        while len(self.tail) > len(self.shapes):
            self.shapes = np.concatenate([self.shapes, self.shapes])
        self.shapes[first : len(self.tail)] = [shape(new[k]) for k in beyond.tolist()]
        self.update(zip(new, at.tolist(), strict=True))

    def of(self, tokens: list[bytes]) -> np.ndarray:
        if len(self) > KEPT:
            self.clear()
            self.tail.clear()
        if new := [w for w in set(tokens) if w not in self]:
            self._learn(new)
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


@dataclass
class Head:
    """Keys of the clustered words, ascending, with what tasks need of each."""

    keys: np.ndarray
    columns: dict[str, np.ndarray]

    def codes(self) -> _Codes:
        return _Codes(self.keys)


def exchange(bigrams: np.ndarray, symbols: int, classes: int, rounds: int) -> np.ndarray:
    """Class of each of the first ``symbols`` rows of a square count matrix.

    Rows beyond keep a class of their own.  A word starts in the class of its rank
    modulo ``classes``; in each round, each word in turn moves to where the sum of
    ``N log N`` over class bigrams, less that over their margins, is largest.
    """
    n = len(bigrams)
    own = np.arange(symbols) % max(classes, 1)
    of = np.concatenate([own, classes + np.arange(n - symbols)])
    total = classes + n - symbols
    pick = np.zeros((n, total))
    pick[np.arange(n), of] = 1
    grid = pick.T @ bigrams @ pick
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-12))
    for _ in range(rounds):
        moved = 0
        for w in range(symbols):
            old = of[w]
            right = np.bincount(of, bigrams[w], total)  # classes after the word
            left = np.bincount(of, bigrams[:, w], total)
            same = bigrams[w, w]
            right[old] -= same
            left[old] -= same
            if right.sum() + left.sum() + same == 0:
                continue
            grid[old] -= right
            grid[:, old] -= left
            grid[old, old] -= same
            # Gain of joining class c, for all c at once, with the word taken out.
            gain = (xlogx(grid[:classes] + right) - xlogx(grid[:classes])).sum(1)
            gain += (xlogx(grid[:, :classes] + left[:, None]) - xlogx(grid[:, :classes])).sum(0)
            diagonal = grid[np.arange(classes), np.arange(classes)]
            r, l = right[:classes], left[:classes]
            gain += xlogx(diagonal + r + l + same) - xlogx(diagonal + r) - xlogx(diagonal + l) + xlogx(diagonal)
            # Margins with the word's neighbours, which stay where they are.
            rows, cols = (grid.sum(1) + left)[:classes], (grid.sum(0) + right)[:classes]
            gain -= xlogx(rows + right.sum() + same) - xlogx(rows) + xlogx(cols + left.sum() + same) - xlogx(cols)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            grid[new] += right
            grid[:, new] += left
            grid[new, new] += same
            of[w] = new
            moved += new != old
        if not moved:
            break
    return of


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(grid: np.ndarray) -> float:
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(0)).sum() - _xlogx(grid.sum(1)).sum())


def best_classes(grid: np.ndarray, classes: int, old: np.ndarray, right: np.ndarray, left: np.ndarray, same: np.ndarray) -> np.ndarray:
    """The class that each word is to move to, each taken out of ``grid`` alone.

    ``right`` and ``left`` count a word's neighbours by class, (words, classes of the
    grid), ``same`` itself after itself, and ``old`` is its class.  A word of a class
    beyond ``classes`` has to move.  The exact gain in likelihood is taken for the
    ``TRIED`` classes of the largest first-order gain and for the word's own.
    """
    logs = np.log(grid + 0.5)
    margin = lambda axis: np.log(grid.sum(axis) + 0.5)
    rough = right @ (logs[:classes] - margin(1)[:classes, None]).T + left @ (logs[:, :classes] - margin(0)[:classes])
    tried = min(TRIED, classes)
    out = np.empty(len(old), np.int64)
    for first in range(0, len(old), MOVED):
        part = slice(first, first + MOVED)
        o, s = old[part], same[part].astype(float)
        n = np.arange(len(o))
        inside = o < classes
        c = np.argpartition(-rough[part], tried - 1, 1)[:, :tried]
        c = np.concatenate([np.where(inside, o, c[:, 0])[:, None], c], 1)
        r, l = right[part].astype(float), left[part].astype(float)  # noqa: E741
        r[n, o] -= s
        l[n, o] -= s
        # Rows and columns of the classes tried, with the word taken out.
        own = c == o[:, None]
        rows, cols = grid[c], grid.T[c]
        rows -= own[:, :, None] * r[:, None, :]
        cols -= own[:, :, None] * l[:, None, :]
        rc, lc = np.take_along_axis(r, c, 1), np.take_along_axis(l, c, 1)
        at = np.broadcast_to(o[:, None, None], (*c.shape, 1))
        take = lambda x, by: np.put_along_axis(x, at, np.take_along_axis(x, at, 2) - by[:, :, None], 2)
        take(rows, lc + own * s[:, None])
        take(cols, rc + own * s[:, None])
        gain = (_xlogx(rows + r[:, None, :]) - _xlogx(rows)).sum(2) + (_xlogx(cols + l[:, None, :]) - _xlogx(cols)).sum(2)
        diagonal, s = np.take_along_axis(rows, c[:, :, None], 2)[:, :, 0], s[:, None]
        gain += _xlogx(diagonal + rc + lc + s) - _xlogx(diagonal + rc) - _xlogx(diagonal + lc) + _xlogx(diagonal)
        # Margins with the word's neighbours, which stay where they are.
        after, before = rows.sum(2) + lc, cols.sum(2) + rc
        gain -= _xlogx(after + r.sum(1)[:, None] + s) - _xlogx(after) + _xlogx(before + l.sum(1)[:, None] + s) - _xlogx(before)
        best = gain.argmax(1)
        stays = inside & (gain[n, best] <= gain[:, 0] + 1e-9)
        out[part] = np.where(stays, o, c[n, best])
    return out


SIDES = ("w0", "o0", "n0", "w1", "o1", "n1")


def _bytes(w: np.ndarray, o: np.ndarray, n: np.ndarray) -> tuple[bytes, ...]:
    """Words in ascending order as differences, their neighbours and counts."""
    return tuple(x.astype(np.int32).tobytes() for x in (np.diff(w, prepend=0), o, n))


def _arrays(row: tuple[bytes, ...]) -> tuple[np.ndarray, ...]:
    w, o, n = (np.frombuffer(x, np.int32).astype(np.int64) for x in row)
    return np.cumsum(w), o, n


def word_bigrams(learn: DataFrame, shared, size: int, parts: int) -> DataFrame:
    """Counts of words of ``shared``, shapes and the end after one another, by the word.

    A row for each range of words, as bytes: (w0, o0, n0) words, what comes after them and
    how often; (w1, o1, n1) the same with what comes before, of clustered words only.
    """
    symbols = size + SHAPES + 1

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, end = shared.value.codes(), symbols - 1
        held, many = [], 0

        def out() -> pd.DataFrame:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            a, b = at // symbols, at % symbols
            order = np.argsort(b, kind="stable")
            order = order[b[order] < size]
            rows = []
            for side, w, o, k in ((0, a, b, n), (1, b[order], a[order], n[order])):
                # Of shapes and the end, which meet nearly all words, the other word decides the range.
                part = np.where(w < size, w, o) * (RANGES * parts) // symbols
                order = np.argsort(part, kind="stable")
                part, w, o, k = part[order], w[order], o[order], k[order]
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                for s, e in zip(cuts, [*cuts[1:], len(part)], strict=False):
                    rows.append((int(part[s]), side, *_bytes(w[s:e], o[s:e], k[s:e])))
            return pd.DataFrame(rows, columns=["part", "side", "w", "o", "n"]).astype({"part": "int32", "side": "int32"})

        for batch in batches:
            for text in batch["text"]:
                got = codes.of(words(text))
                beyond = got < 0
                got[beyond] = size + codes.shapes[-got[beyond] - 1]
                held.append(np.concatenate([[end], got]) * symbols + np.concatenate([got, [end]]))
                many += len(got) + 1
                if many >= BIGRAMS:
                    yield out()
                    many = 0
        if held:
            yield out()

    @tidied
    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, ([], [])

        def out() -> pd.DataFrame:
            row = []
            for side in held:
                w, o, n = (np.concatenate(x) for x in zip(*side, strict=True)) if side else [np.zeros(0, np.int64)] * 3
                key = w * symbols + o
                order = np.argsort(key, kind="stable")  # of runs in order
                key, n = key[order], n[order]
                starts = np.flatnonzero(np.diff(key, prepend=-1))
                row += _bytes(key[starts] // symbols, key[starts] % symbols, np.add.reduceat(n, starts) if len(starts) else n)
            return pd.DataFrame([row], columns=list(SIDES))

        for batch in batches:
            for part, side, *row in batch[["part", "side", "w", "o", "n"]].itertuples(index=False):
                if part != at and at is not None:
                    yield out()
                    held = ([], [])
                at = part
                held[side].append(_arrays(row))
        if at is not None:
            yield out()

    found = learn.mapInPandas(run, "part int, side int, w binary, o binary, n binary")
    found = found.repartition(parts, "part").sortWithinPartitions("part")
    return found.mapInPandas(merged, ", ".join(f"{c} binary" for c in SIDES))


def class_bigrams(bigrams: DataFrame, of: np.ndarray, total: int) -> np.ndarray:
    """``bigrams`` summed by the classes ``of`` its symbols."""
    shared = bigrams.sparkSession.sparkContext.broadcast(of)

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, of = np.zeros(total * total), shared.value.astype(np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                w, o, n = _arrays(row)
                found += np.bincount(of[w] * total + of[o], n, total * total)
        at = np.flatnonzero(found)
        yield pd.DataFrame({"pair": at, "n": found[at].astype(np.int64)})

    got = bigrams.select(*SIDES[:3]).mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    grid = np.zeros(total * total)
    grid[got["pair"].to_numpy()] = got["n"].to_numpy()
    return grid.reshape(total, total)


def moved(bigrams: DataFrame, of: np.ndarray, grid: np.ndarray, size: int, classes: int) -> np.ndarray:
    """``of`` with each of the first ``size`` symbols, the words, moved to its best class; no shuffle."""
    total = len(grid)
    shared = bigrams.sparkSession.sparkContext.broadcast((of, grid))

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, grid = shared.value
        of = of.astype(np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                after, before = _arrays(row[:3]), _arrays(row[3:])
                found = np.unique(np.concatenate([after[0], before[0]]))
                found = found[found < size]
                for first in range(0, len(found), 64 * MOVED):
                    mine = found[first : first + 64 * MOVED]
                    counts = []
                    for w, o, n in (after, before):
                        s, e = np.searchsorted(w, [mine[0], mine[-1] + 1])
                        at = np.searchsorted(mine, w[s:e])
                        counts.append(np.bincount(at * total + of[o[s:e]], n[s:e], len(mine) * total).reshape(-1, total))
                        if len(counts) == 1:
                            twice = w[s:e] == o[s:e]
                            same = np.bincount(at[twice], n[s:e][twice], len(mine))
                    to = best_classes(grid, classes, of[mine], *counts, same)
                    yield pd.DataFrame({"w": mine.astype(np.int32), "class": to.astype(np.int32)})

    got = bigrams.mapInPandas(run, "w int, class int").toArrow()
    shared.unpersist()
    new = of.copy()
    new[got["w"].to_numpy()] = got["class"].to_numpy()
    return new


@dataclass
class Model:
    head: Head
    step: np.ndarray  #: log10 probability of a class after a class
    shape_class: int  #: the class of shape 0
    shape_size: np.ndarray  #: training tokens of each shape among words that are not clustered
    shape_words: np.ndarray  #: distinct ones
    tokens: int
    vocabulary: int


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """(doc_id, text) -> the model, and the table of all counts."""
    learn = docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("string").alias("text"))
    counts = staged(count_words(learn), "lm-counts")
    tokens, vocabulary = counts.agg(F.sum("c"), F.count("*")).first()
    tokens = tokens or 0
    head = counts.where((F.col("c") >= LEAST) & (F.col("h") != END_KEY)).select("h", "c").toArrow()
    keys, c = head["h"].to_numpy(), head["c"].to_numpy()
    order = np.argsort(keys)
    keys, c = keys[order], c[order]
    size = len(keys)
    shapes = counts.where((F.col("shape") >= 0) & (F.col("c") < LEAST)).groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    shape_size, shape_words = np.zeros(SHAPES), np.zeros(SHAPES)
    for row in shapes:
        shape_size[row["shape"]], shape_words[row["shape"]] = row["c"], row["n"]

    # Symbols: the clustered words, the shapes, the end (also before the first token).
    shared = docs.sparkSession.sparkContext.broadcast(Head(keys, {}))
    bigrams = staged(word_bigrams(learn, shared, size, partitions(learn)), "lm-bigrams")
    shared.unpersist()
    top = min(SEEDS, size)
    classes = min(CLASSES, top)
    total = classes + SHAPES + 1
    beyond = np.arange(SHAPES + 1)
    if size:
        seeds = np.lexsort((keys, -c))[:top]
        # Before the first pass the other words are all in a class of their own, the last shape's.
        rank = np.concatenate([np.full(size, top + SHAPES - 1), top + beyond])
        rank[seeds] = np.arange(top)
        start = exchange(class_bigrams(bigrams, rank, top + SHAPES + 1), top, classes, ROUNDS)
        of = start[rank].astype(np.int16)
    else:
        of = (classes + beyond).astype(np.int16)
    grid = class_bigrams(bigrams, of, total)
    for turn in range(PASSES if size else 0):
        new = moved(bigrams, of, grid, size, classes)
        then = class_bigrams(bigrams, new, total)
        # The first pass brings the words out of the shape's class, so it always counts.
        if turn and likelihood(then) <= likelihood(grid):
            break
        of, grid = new, then
    mass = grid.sum(0)
    alone = (mass + 1) / (mass.sum() + total)
    step = np.log10((grid + BACK * alone) / (grid.sum(1, keepdims=True) + BACK))

    word_class = of[:size].astype(np.int64)
    class_words = np.bincount(word_class, minlength=total)
    class_size = np.bincount(word_class, c, minlength=total)
    columns = {
        "base": np.log10((c + ADD) / (tokens + ADD * (vocabulary + 1))),
        "emit": np.log10((c + ADD) / (class_size[word_class] + ADD * (class_words[word_class] + 1))),
        "class": of[:size],
    }
    model = Model(Head(keys, columns), step, classes, shape_size, shape_words, int(tokens), int(vocabulary))
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidied
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        codes, head = m.head.codes(), m.head.columns
        last = len(m.step) - 1
        for batch in batches:
            rows = []
            for text in batch["text"]:
                tokens = words(text)
                got = codes.of(tokens)
                in_head, beyond = got[got >= 0], got[got < 0]
                classes = np.empty(len(got), np.int64)
                classes[got >= 0] = head["class"][in_head]
                tail, times = np.unique(beyond, return_counts=True)
                classes[got < 0] = m.shape_class + codes.shapes[-beyond - 1]
                path = np.concatenate([[last], classes, [last]])
                moves = float(m.step[path[:-1], path[1:]].sum())
                rows.append((len(tokens) + 1, len(in_head), float(head["base"][in_head].sum()), moves + float(head["emit"][in_head].sum()), [codes.tail[-t - 1] for t in tail.tolist()], codes.shapes[-tail - 1].tolist(), times.tolist()))
            yield pd.DataFrame(rows, columns=["n_tokens", "in_head", "base", "model", "h", "shape", "times"]).assign(doc_id=batch["doc_id"].astype("Int64"))

    schema = "doc_id long, n_tokens long, in_head long, base double, model double, h array<long>, shape array<int>, times array<long>"
    read = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInPandas(partial, schema)
    rows = staged(read.withColumn("row", F.monotonically_increasing_id()), "lm-rows")

    norm = model.tokens + ADD * (model.vocabulary + 1)
    shape_norm = F.array(*[F.lit(float(n + ADD * (v + 1))) for n, v in zip(model.shape_size, model.shape_words, strict=True)])
    tail = rows.select("row", F.explode(F.arrays_zip("h", "shape", "times")).alias("t")).select("row", "t.*")
    tail = tail.join(counts.select("h", "c"), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    tail = tail.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + ADD) / norm)).alias("tail_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + ADD) / F.get(shape_norm, F.col("shape")))).alias("tail_model"),
    )
    end = counts.where(F.col("h") == END_KEY).select("c").first()
    end_count = end["c"] if end else 0
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.join(tail, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("in_head") + none("tail_known") + int(end_count > 0)).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + none("tail_base") + float(np.log10((end_count + ADD) / norm))).alias("base_score"),
        (F.col("model") + none("tail_model")).alias("score"),
    )


def language_scores(docs: DataFrame) -> DataFrame:
    model, counts = train(docs)
    return score(docs, model, counts)
