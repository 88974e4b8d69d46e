"""The full lookup: every pair is compared, once, and no pair becomes a row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolink.functions import hash_scan
from cartolink.functions.bits import HASH_WEIGHTS
from cartolink.operators import retrieval
from cartolink.plans import QUERIES

HASH = pa.list_(pa.int64())


def odd_hashes(rng, n, alphabet):
    """Hashes of four words from few values, so that many are equal; some are null, of other length, or hold a null."""
    def one():
        words = [int(alphabet[rng.integers(len(alphabet))]) for _ in range(4)]
        return [words] * 12 + [None, words[:2], [], [*words[:3], None]]
    return [{c: (o := one())[rng.integers(len(o))] for c in hash_scan.KINDS} for _ in range(n)]


def brute(queries, exemplars, k):
    out = {}
    for q in queries:
        for d in exemplars:
            if q["skip"] is not None and q["skip"] == d["skip"]:
                continue
            total, weight, near = 0.0, 0.0, None
            for c, w in HASH_WEIGHTS.items():
                if q[c] is not None and d[c] is not None and None not in q[c] + d[c] and len(q[c]) == len(d[c]):
                    bits = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(q[c], d[c]))
                    total, weight, near = total + w * bits / 256, weight + w, bits if c == "phash" else near
            if weight > 0:
                out.setdefault(q["q_id"], []).append((-(1 - total / weight), d["d_id"], near))
    return {q: sorted(rows, key=lambda r: r[:2])[:k] for q, rows in out.items()}


@pytest.mark.parametrize("ids", [int, lambda k: f"n{k}"])
@pytest.mark.parametrize("values", [3, 1000])
def test_best_of_all_pairs(monkeypatch, ids, values):
    for name, size in (("QUERY_ROWS", 7), ("ROWS", 16), ("WAITING", 100)):
        monkeypatch.setattr(hash_scan, name, size)
    rng = np.random.default_rng(values)
    alphabet = rng.integers(-(2**63), 2**63 - 1, values)
    exemplars = [{"d_id": ids(int(k)), "skip": ids(int(k)), **h} for k, h in zip(rng.permutation(300), odd_hashes(rng, 300, alphabet))]
    queries = [{"q_id": k, "skip": None if k % 9 == 0 else ids(k), **h} for k, h in enumerate(odd_hashes(rng, 40, alphabet))]
    kind = pa.int64() if ids is int else pa.string()
    table = lambda rows, key, t: pa.Table.from_pylist(rows, pa.schema([(key, t), ("skip", kind), *[(c, HASH) for c in hash_scan.KINDS]]))
    best = hash_scan.Best(table(queries, "q_id", pa.int64()), 5, 256, ["d_id"])
    for first in range(0, 300, 70):
        best.add(table(exemplars[first : first + 70], "d_id", kind))
    got = {}
    for r in best.found().to_pylist():
        got.setdefault(r["q_id"], []).append((-r["sim"], r["d_id"], r["bits"]))
    assert got == brute(queries, exemplars, 5)


def test_blocks_of_queries_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "SENT_ROWS", 4)
    monkeypatch.setattr(retrieval, "BATCH_ROWS", 9)
    rng = np.random.default_rng(2)
    alphabet = rng.integers(-(2**63), 2**63 - 1, 4)
    exemplars = [(k if k % 10 else None, "g", f"n{k}", *h.values()) for k, h in enumerate(odd_hashes(rng, 60, alphabet))]
    queries = [(k if k else None, *h.values()) for k, h in enumerate(odd_hashes(rng, 15, alphabet))]
    hashes = lambda prefix: ", ".join(f"{prefix}{c} array<long>" for c in hash_scan.KINDS)
    d = spark.createDataFrame(exemplars, f"d_id long, grp string, name string, {hashes('')}").repartition(3)
    q = spark.createDataFrame(queries, f"q_id long, {hashes('q_')}")
    rows = retrieval.best_by_hashes(q, d, 6, skip=("q_id", "d_id")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["place"]):
        got.setdefault(r["q_id"], []).append((-r["sim"], r["d_id"], r["bits"]))
    named = lambda rows, key, at: [{key: r[0], "skip": r[0], **dict(zip(hash_scan.KINDS, r[at:]))} for r in rows if r[0] is not None]
    assert got == brute(named(queries, "q_id", 1), named(exemplars, "d_id", 3), 6)
    assert retrieval.best_by_hashes(q.limit(0), d, 6).count() == retrieval.best_by_hashes(q, d.limit(0), 6).count() == 0


def test_pairs_are_no_rows(spark, tmp_path):
    """Before, each pair was a row of a nested loop join, and all were made twice: for the shortlist and for the nearest."""
    vec = spark.range(200).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.sin(i * 3 + F.col("id")).cast("float")).alias("embedding"), (F.col("id") % 3).cast("int").alias("label"))
    vec.write.parquet(f"{tmp_path}/embeddings.parquet")
    plan = QUERIES["full_lookup"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert plan.count("MapInArrow") == 1
