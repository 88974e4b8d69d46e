"""Mixing sources to target weights by weighted fair queueing [native].

Every source is a queue, its documents shuffled by a hash of their id.  A
document's virtual finish time is the number of its source's words up to and
with it, over the source's target.  All queues are merged by that time, range by
range, and the merged order is cut where the total budget is used up.  A source
whose target is above its size is read again, at most ``max_epochs`` times.

No step gathers a source: a queue is cut into ranges of the hash, ranges are
summed before they are shuffled, and only the ranges' sums (one row a range) are
ordered as a whole.  The merged order is cut in the same way, by ranges of the
virtual time.

Null and empty cases: a null or blank text has size 0 and is never taken; a null
source is a source of its own, last in order; rows with null or equal ids are
kept apart and each is placed on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Rows in a range of a queue, about; and ranges of a queue at least.
RANGE_ROWS, LEAST_RANGES = 10_000, 256
#: Ranges of the virtual time in the merged order.
TIME_RANGES = 4096


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """(key, source_size) -> (key, source_size, target).

    Water-filling in closed form: by rising ``max_epochs * size / weight`` the
    capped sources are a prefix, and the water level is the largest level that
    any prefix leaves.  ``sizes`` has one row for each distinct source.
    """
    by_key, by_ratio = Window.orderBy("key"), Window.orderBy("ratio", "key")
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    s = s.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("free", F.col("ratio") >= F.col("left") / F.col("open"))
    level = F.min_by(F.struct("left", "open"), F.when(F.col("free"), F.struct("ratio", "key"))).over(every)
    s = s.withColumn("level", level)
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.open")
    return s.select("key", "source_size", F.when(F.col("free"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, source) -> doc_id, size, source_size, target, taken, source, and ``carry``.

    Sources by code point, null last, take ``weights`` in turn.  The budget is
    the number of all words.  ``taken`` counts repeats.  ``carry`` names columns of
    ``docs`` that each row keeps.
    """
    key = F.when(F.col("source").isNull(), "x").otherwise(F.concat(F.lit("v"), F.col("source").cast("string")))
    rows = staged(docs.select("doc_id", key.alias("key"), word_count(F.col("text")).alias("size"), *carry), "mix-sizes")
    ranges = max(LEAST_RANGES, rows.count() // RANGE_ROWS)
    rows = rows.withColumn("h", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("range", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * ranges / 2**32))

    sums = rows.groupBy("key", "range").agg(F.sum("size").alias("words"))
    goal = targets(sums.groupBy("key").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words").join(goal, "key")

    queue = Window.partitionBy("key", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(starts, ["key", "range"]).withColumn("upto", F.col("before") + F.sum("size").over(queue))
    placed = staged(placed.select("doc_id", "key", "size", "source_size", "target", "upto", *carry), "mix-placed")

    epochs = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    turn = placed.where("size > 0").select("key", "size", "target", "source_size", "upto", F.explode(epochs).alias("epoch"))
    turn = turn.select("key", "size", ((F.col("epoch") * F.col("source_size") + F.col("upto")) / F.col("target")).alias("time"))
    # All that ends by time 1 fits, as the targets add up to the budget at most.
    # Nothing after the last queue's first overrun can fit.
    by_source = turn.groupBy("key").agg(F.min(F.when(F.col("time") > 1, F.col("time"))).alias("over"), F.sum(F.when(F.col("time") <= 1, F.col("size"))).alias("used"))
    last, used = by_source.agg(F.max("over"), F.sum("used")).first()
    budget = placed.agg(F.sum("size")).first()[0] or 0
    cut_time, cut_key = 1.0, "z"
    if last is not None:
        spare = budget - (used or 0)
        late = turn.where((F.col("time") > 1) & (F.col("time") <= last))
        slot = F.least(F.floor((F.col("time") - 1) * TIME_RANGES / (last - 1)), F.lit(TIME_RANGES - 1))
        late = late.withColumn("slot", slot)
        slots = late.groupBy("slot").agg(F.sum("size").alias("words"))
        so_far = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        slots = slots.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        # The slot in which the budget ends; all slots before it fit.
        row = slots.where(F.col("before") <= spare).agg(F.max(F.struct("slot", "before"))).first()[0]
        merged = Window.orderBy("time", "key").rowsBetween(Window.unboundedPreceding, 0)
        inside = late.where(F.col("slot") == row["slot"]).withColumn("sum", row["before"] + F.sum("size").over(merged))
        end = inside.where(F.col("sum") <= spare).agg(F.max(F.struct("time", "key"))).first()[0]
        if end is None:
            end = late.where(F.col("slot") < row["slot"]).agg(F.max(F.struct("time", "key"))).first()[0]
        if end is not None:
            cut_time, cut_key = end["time"], end["key"]
    time = lambda e: (F.lit(e) * F.col("source_size") + F.col("upto")) / F.col("target")
    in_mix = lambda e: (time(e) <= 1) | (time(e) < cut_time) | ((time(e) == cut_time) & (F.col("key") <= cut_key))
    times = sum((F.when(in_mix(e), 1).otherwise(0) for e in range(max_epochs)), F.lit(0))
    taken = F.when(F.col("size") > 0, times * F.col("size")).otherwise(0).cast("long")
    source = F.when(F.col("key") != "x", F.expr("substring(key, 2)"))
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), source.alias("source"), *carry)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'x' ELSE 'v' || source END AS key,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT key, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY key),
r AS (
  SELECT *, (3 * source_size)::DOUBLE / w AS ratio,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS lft,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS opn
  FROM s WINDOW b AS (ORDER BY (3 * source_size)::DOUBLE / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT lft AS ll, opn AS lo FROM r WHERE ratio >= lft::DOUBLE / opn ORDER BY ratio, key LIMIT 1),
t AS (
  SELECT key, source_size, CASE WHEN ratio >= lft::DOUBLE / opn THEN (w * ll)::DOUBLE / lo ELSE (3 * source_size)::DOUBLE END AS target
  FROM r, l),
q AS (
  SELECT d.doc_id, d.key, d.size, t.source_size, t.target,
         row_number() OVER (ORDER BY d.key, d.h, d.doc_id, d.size) AS n,
         sum(d.size) OVER (PARTITION BY d.key ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t USING (key)),
i AS (
  SELECT q.n, q.key, q.size, (e.e * q.source_size + q.upto)::DOUBLE / q.target AS time
  FROM q, (SELECT unnest([0, 1, 2]) AS e) e WHERE q.size > 0),
m AS (SELECT n, size, sum(size) OVER (ORDER BY time, key ROWS UNBOUNDED PRECEDING) AS total FROM i),
k AS (SELECT n, sum(size) AS taken FROM m WHERE total <= (SELECT sum(size) FROM d) GROUP BY n)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0)::BIGINT AS taken,
       CASE WHEN q.key <> 'x' THEN substr(q.key, 2) END AS source
FROM q LEFT JOIN k USING (n)
"""
