"""Sets that show equal keys meet in a bucket; links among a bucket's members.

Keys travel packed: a task's keys and the ids that show them are dealt by the key's
upper half to labels, a few for each partition, and go through one shuffle as blocks
of bytes.  Where a label's blocks meet, a sort finds the keys that several ids show.

Links come in two steps.  First every id meets the bucket leader (a bucket's least
id) that most of its buckets name, so families of near copies fall together.  Then
each bucket that still holds several components is compared within: in blocks of at
most ``BLOCK`` members, each pair of blocks once.  A pair is passed over only if a
lower bound on its difference (``sketches``: the parity of hash counts, by which a
difference can only shrink) excludes a link; sketches go first, and whole sets follow
for members with a partner left.  Inside a block pair one member after another, the one
with the most open partners first, is compared with all that are not yet connected to it.  So no candidate is dropped, and what comes out is at most
one row for each member, never a list of all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shingles import mixed, tidied
from .staging import Sieve, staged

#: Keys that a task packs at once, labels for each partition, members of a block.
PACKED, LABELS, BLOCK = 500_000, 8, 256
#: Characters of text whose keys a partition is to hold at most.
PART_CHARS = 32_000_000
PACKED_SCHEMA = "part int, keys binary, ids binary"


def partitions(docs: DataFrame) -> int:
    """As the cluster's settings ask for, more where the texts are larger than that."""
    chars = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-chars // PART_CHARS))


class Packer:
    """Collects (keys, id) and gives blocks for each label."""

    def __init__(self, parts: int):
        self.labels, self.keys, self.ids, self.many = LABELS * parts, [], [], 0

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        self.keys.append(keys)
        self.ids.append(ids)
        self.many += len(keys)

    def full(self) -> bool:
        return self.many >= PACKED

    def blocks(self) -> pd.DataFrame:
        keys, ids = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((self.keys, np.uint64), (self.ids, np.int64)))
        self.keys, self.ids, self.many = [], [], 0
        label = ((keys >> np.uint64(32)) * np.uint64(self.labels) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(label)
        label, low, ids = label[order], keys[order].astype(np.uint32), ids[order]
        cuts = np.flatnonzero(np.diff(label, prepend=-1))
        ends = np.append(cuts[1:], len(label))[: len(cuts)]
        return pd.DataFrame({"part": label[cuts], "keys": [low[s:e].tobytes() for s, e in zip(cuts, ends, strict=True)], "ids": [ids[s:e].tobytes() for s, e in zip(cuts, ends, strict=True)]}).astype({"part": "int32"})


def padded(blocks: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    return blocks.assign(**{c: None for c in columns if c not in blocks})[columns]


def _shared(keys: list[bytes], ids: list[bytes]) -> dict[str, np.ndarray]:
    k, i = np.frombuffer(b"".join(keys), np.uint32), np.frombuffer(b"".join(ids), np.int64)
    order = np.argsort(k)
    k, i = k[order], i[order]
    same = k[1:] == k[:-1]
    several = np.append(same, False) | np.append(False, same)
    k, i = k[several], i[several]
    order = np.lexsort((i, k))
    k, i = k[order], i[order]
    new = np.append(True, (k[1:] != k[:-1]) | (i[1:] != i[:-1]))[: len(k)]
    k, i = k[new], i[new]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
    sizes = np.diff(np.append(starts, len(k)))
    if len(k):
        prints = mixed(np.bitwise_xor.reduceat(mixed(i.view(np.uint64)), starts) + sizes.astype(np.uint64)).view(np.int64)
    else:
        prints = np.zeros(0, np.int64)
    many = np.repeat(sizes > 1, sizes)
    return {"bucket": np.repeat(prints, sizes)[many], "a": np.repeat(i[starts], sizes)[many], "b": i[many]}


def meet(rows: DataFrame, parts: int, payload: str) -> DataFrame:
    """Packed blocks -> bucket, a, b: for a key that several ids show each of them as b, the least as a.

    ``bucket`` is a hash of the ids: keys that the same ids show are one bucket.  ``payload``
    lists further columns ("name type, ...").  Rows whose ``keys`` are null carry them and
    come out as they are, with null bucket.
    """
    names = [c.split()[0] for c in payload.split(", ")]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, ids, schema = None, [], [], None

        def found() -> pa.RecordBatch:
            got = _shared(keys, ids)
            none = [pa.nulls(len(got["b"]), f.type) for f in schema]
            return pa.record_batch([*none, *map(pa.array, got.values())], [*names, *got])

        for batch in batches:
            schema = [batch.schema.field(c) for c in names]
            carried = batch.filter(pc.is_null(batch["keys"]))
            none = pa.nulls(len(carried), pa.int64())
            yield pa.record_batch([*(carried[c] for c in names), none, none, none], [*names, "bucket", "a", "b"])
            blocks = batch.filter(pc.is_valid(batch["keys"]))
            for label, k, i in zip(blocks["part"].to_pylist(), blocks["keys"].to_pylist(), blocks["ids"].to_pylist(), strict=True):
                if label != at and keys:
                    yield found()
                    keys, ids = [], []
                at = label
                keys.append(k)
                ids.append(i)
        if keys:
            yield found()

    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, f"{payload}, bucket long, a long, b long")


# -- links among the members of a group ------------------------------------------


def width_of(size: int) -> int:
    """Bits of the sketch of a set of this size."""
    return max(512, 1 << (size - 1).bit_length())


def sketches(sets: list[np.ndarray], width: int = 0) -> np.ndarray:
    """(sets, words): parity of how many hashes of a set fall on each bit."""
    width = width or width_of(max(map(len, sets)))
    out = np.empty((len(sets), width // 64), np.uint64)
    step = max(1, (1 << 22) // width)
    for first in range(0, len(sets), step):
        part = sets[first : first + step]
        at = np.repeat(np.arange(len(part)) * width, [len(x) for x in part])
        at += (np.concatenate(part) & np.uint64(width - 1)).astype(np.int64)
        counts = (np.bincount(at, minlength=len(part) * width) & 1).astype(np.uint8)
        out[first : first + step] = np.packbits(counts, bitorder="little").view(np.uint64).reshape(len(part), -1)
    return out


def may_link(size: np.ndarray, sk: np.ndarray, num: int, den: int) -> np.ndarray:
    """(sets, sets): False where sizes or sketches exclude a link."""
    mask, differ = fits(size[:, None], size, num, den), np.zeros((len(size), len(size)), np.int64)
    for w in range(sk.shape[1]):
        differ += np.bitwise_count(sk[:, w, None] ^ sk[:, w])
    return mask & (differ * (den + num) <= (size[:, None] + size) * (den - num))


def fits(s: np.ndarray, t: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * np.minimum(s, t) >= num * np.maximum(s, t)


def folded(sk: list[bytes]) -> np.ndarray:
    """(sets, words): sketches of several widths as wide as the narrowest; halves join by exclusive or."""
    rows = [np.frombuffer(x, np.uint64) for x in sk]
    least = min(map(len, rows))
    return np.stack([np.bitwise_xor.reduce(r.reshape(-1, least), 0) for r in rows])


def group_links(sets: list[np.ndarray], label: np.ndarray, num: int, den: int, lead: int = 0, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs (i, j) of linked sets that connect whatever links connect among different labels.

    With ``side`` only pairs of different sides count.  No set is empty; each is sorted.
    """
    size, out = np.array([len(x) for x in sets]), []

    def met(k: int, others: np.ndarray) -> np.ndarray:
        flat, left = np.concatenate([sets[i] for i in others.tolist()]), sets[k]
        hit = left[np.minimum(np.searchsorted(left, flat), len(left) - 1)] == flat
        both = np.add.reduceat(hit, np.append(0, np.cumsum(size[others])[:-1]), dtype=np.int64)
        return others[den * both >= num * (size[k] + size[others] - both)]

    def join(k: int, others: np.ndarray) -> bool:
        """Compare; whether labels have changed."""
        done = False
        for i in met(k, others).tolist() if len(others) else []:
            if label[i] != label[k]:
                out.append((k, i))
                label[label == label[i]] = label[k]
                done = True
        return done

    label = label.copy()
    open_ = (label != label[lead]) & fits(size, size[lead], num, den)
    if side is not None:
        open_ &= side != side[lead]
    join(lead, np.flatnonzero(open_))
    if (label == label[0]).all():
        return out
    mask = label[:, None] != label
    if side is not None:
        mask &= side[:, None] != side
    mask[lead] = mask[:, lead] = False
    if mask.any():
        mask &= may_link(size, sketches(sets), num, den)
    while mask.any():
        k = int(mask.sum(1).argmax())
        changed = join(k, np.flatnonzero(mask[k]))
        mask[k] = mask[:, k] = False
        if changed:
            mask &= label[:, None] != label
    return out


GROUP = ["g", "i", "j"]


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows with groups complete; groups come one after another."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[GROUP].to_numpy()
        if held and (held[-1][GROUP].to_numpy()[-1] == keys[-1]).all() and (keys == keys[-1]).all():
            held.append(batch)
            continue
        last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        ready = pd.concat([*held, batch[:last]]) if held else batch[:last]
        if len(ready):
            yield ready
        held = [batch[last:]]
    if held:
        yield pd.concat(held)


def groups_of(part: pd.DataFrame) -> Iterator[tuple[int, int, bool]]:
    """(first row, last row + 1, whether pairs of different sides only count) of each group of several rows."""
    keys = part[GROUP].to_numpy()
    cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))).tolist()
    for s, e in zip(cuts, [*cuts[1:], len(part)], strict=True):
        if e - s > 1:
            yield s, e, bool(keys[s, 1] != keys[s, 2])


def gathered(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def compared(rows: DataFrame, content: DataFrame, sets_of: Callable, num: int, den: int) -> DataFrame:
    """(g, i, j, node, root, lead, side) -> links (a, b) of nodes, within each group (g, i, j)."""

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches):
            found = []
            nodes, roots, lead, side = (part[c].to_numpy() for c in ("node", "root", "lead", "side"))
            sets = sets_of(part["x"].tolist())
            for s, e, cross in groups_of(part):
                for i, j in group_links(sets[s:e], roots[s:e], num, den, int(lead[s:e].argmax()), side[s:e] if cross else None):
                    found.append((nodes[s + i], nodes[s + j]))
            yield pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    # Merged at any size: broadcasting rows where they are few would be another plan at small sizes.
    both = rows.hint("merge").join(content.select("node", "x"), "node").select(*GROUP, "node", "root", "lead", "side", "x")
    return gathered(both).mapInPandas(run, "a long, b long")


#: Rows that a worker turns into sets at once.
SLICE = 1_000


def drawn(content: DataFrame, sets_of: Callable, packed: bool) -> DataFrame:
    """(node, x) of texts -> node, x (the text, or packed its set), the size of its set and its sketch."""

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), SLICE):
                part = batch[first : first + SLICE]
                sets = sets_of(part["x"].tolist())
                part = part.assign(n=[len(x) for x in sets], sk=[sketches([x], width_of(len(x))).tobytes() if len(x) else b"" for x in sets])
                yield (part.assign(x=[x.tobytes() for x in sets]) if packed else part)[part["n"] > 0]

    return content.mapInPandas(run, f"node long, x {'binary' if packed else 'string'}, n long, sk binary")


def unpacked(x: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(one, np.uint64) for one in x]


def alive(rows: DataFrame, content: DataFrame, num: int, den: int) -> DataFrame:
    """The ``rows`` (g, i, j, node, root, lead, side) that could link with one of another root in their group.

    Only sketches travel here, so sets are sent for these rows alone.  Rows that possible links connect
    become a group of their own, named by a hash of its members: what many buckets say is said once.
    """

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches):
            keep, group = np.zeros(len(part), bool), np.zeros(len(part), np.int64)
            sizes, roots, side, sk, nodes = (part[c].to_numpy() for c in ("n", "root", "side", "sk", "node"))
            named = mixed(mixed(nodes.astype(np.int64).view(np.uint64)) + side.astype(np.uint64))
            for s, e, cross in groups_of(part):
                mask = may_link(sizes[s:e], folded(sk[s:e].tolist()), num, den) & (roots[s:e, None] != roots[s:e])
                if cross:
                    mask &= side[s:e, None] != side[s:e]
                live = np.flatnonzero(mask.any(1))
                if not len(live):
                    continue
                mask, label, was = mask[np.ix_(live, live)], np.arange(len(live)), None
                while was is None or (label != was).any():
                    was = label
                    label = np.minimum(label, np.where(mask, label, len(live)).min(1))
                for one in np.unique(label).tolist():
                    at = s + live[label == one]
                    group[at] = mixed(np.bitwise_xor.reduce(named[at], keepdims=True) + np.uint64(2 * len(at) + cross)).view(np.int64)[0]
                keep[s + live] = True
            part = part.assign(g=group, j=(part["i"] != part["j"]).astype(np.int32), i=np.int32(0))
            yield part.loc[keep, names]

    names = [*GROUP, "node", "root", "lead", "side"]
    both = rows.join(content.select("node", "n", "sk"), "node").select(*names, "n", "sk")
    return gathered(both).mapInPandas(run, "g long, i int, j int, node long, root long, lead boolean, side int")


def linked_up(buckets: DataFrame, contents: Callable[[DataFrame], DataFrame], sets_of: Callable, num: int, den: int, known: DataFrame | None = None, packed: bool = False) -> DataFrame:
    """(bucket, a, b) of ``meet`` -> (node, root) for every node on a link, as ``components`` gives it.

    ``contents`` gets the table (node) of ids in buckets and returns (node, x), a text each, of further
    nodes too if that is cheaper; ``sets_of`` makes of a list of texts the hash sets.  ``packed``: sets
    are costly to make, so they are kept.  Rows of one node with different x all count for it.
    ``known`` are links (a, b) besides.
    """
    buckets = staged(buckets.groupBy("bucket", "a", "b").agg(F.count("*").alias("votes")), "mt-buckets")
    votes = buckets.where("a <> b").groupBy("a", "b").agg(F.sum("votes").alias("votes"))
    best = staged(votes.groupBy("b").agg(F.max_by("a", F.struct("votes", -F.col("a"))).alias("a")), "mt-best")
    content = staged(drawn(contents(buckets.select(F.col("b").alias("node")).distinct()), sets_of, packed), "mt-content")
    sets_of = unpacked if packed else sets_of

    # Each node beside its leader, a leader's many nodes in several blocks.
    led = best.groupBy("a").agg(F.count("*").alias("n")).select("a", F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("blocks"))
    same = [F.col("i").alias("j"), "node", F.col("node").alias("root"), "lead", F.lit(0).alias("side")]
    own = best.join(led, "a").select(F.col("a").alias("g"), F.expr("cast(pmod(xxhash64(b), blocks) as int)").alias("i"), F.col("b").alias("node"), F.lit(False).alias("lead"))
    heads = led.select(F.col("a").alias("g"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("i"), F.col("a").alias("node"), F.lit(True).alias("lead"))
    links = compared(own.unionByName(heads).select("g", "i", *same), content, sets_of, num, den)
    roots = components(staged(links.unionByName(known) if known is not None else links, "mt-links"))

    # Buckets whose members are still apart.
    placed = buckets.select("bucket", F.col("b").alias("node")).join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    placed = staged(placed, "mt-placed")
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high")
    open_ = open_.select("bucket", F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("blocks"))
    apart = placed.join(open_, "bucket").withColumn("own", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    apart = apart.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    apart = apart.select(F.col("bucket").alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", F.lit(False).alias("lead"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    apart = staged(alive(apart, content, num, den).distinct(), "mt-alive")
    some = staged(apart.select("node", F.xxhash64("node").alias("key")).distinct(), "mt-some")
    content = content.where(Sieve(some, "key").may(F.xxhash64("node")))
    more = staged(compared(apart, content, sets_of, num, den), "mt-links")
    if more.isEmpty():
        return roots
    moved = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    return components(staged(moved, "mt-links"))
