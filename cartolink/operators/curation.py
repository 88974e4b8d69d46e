"""Set operations over file lists: matching, numbering, plans, counts.

A plan is a table of what would be done; applying it is a separate step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartolink.functions.text import base_name, path_key, stem_of

from .taxonomy import closest, first_wins


def find_partner(files: DataFrame, partners: DataFrame) -> DataFrame:
    """(path) x (path) -> path, partner: by equal stem, else by equal key; the first in order."""
    exact = partners.groupBy(stem_of(base_name(F.col("path"))).alias("stem")).agg(F.min("path").alias("by_stem"))
    loose = partners.groupBy(path_key(F.col("path")).alias("key")).agg(F.min("path").alias("by_key"))
    keyed = files.withColumn("stem", stem_of(base_name(F.col("path")))).withColumn("key", path_key(F.col("path")))
    out = keyed.join(exact, "stem", "left").join(loose, "key", "left")
    return out.select(*files.columns, F.coalesce("by_stem", "by_key").alias("partner"))


def clean_name(file: Column) -> Column:
    """An export's file name as it was before the export: its suffix off, blanks as underscores."""
    # Fixed value: how exported files are named.
    exported = r"_[A-Za-z0-9]+\.rf\.[A-Za-z0-9]+\.([A-Za-z0-9]+)$"
    suffix = F.regexp_extract(file, exported, 1)
    base = F.regexp_replace(file, exported, "")
    dot = F.regexp_extract(file, r"(?s)^(.*)\.([^.]*)$", 2)
    stem = F.when(F.contains(file, F.lit(".")), F.regexp_extract(file, r"(?s)^(.*)\.([^.]*)$", 1)).otherwise(file)
    plain = F.concat(F.regexp_replace(stem, " ", "_"), F.when(dot != "", F.concat(F.lit("."), dot)).otherwise(""))
    return F.when(suffix != "", F.concat(F.regexp_replace(base, " ", "_"), F.lit("."), suffix)).otherwise(plain)


def clean_names(files: DataFrame, known: DataFrame, column: str, cutoff: float = 0.6) -> DataFrame:
    """``files`` with ``clean`` and ``status``: the known name (``key``) that is equal, else the closest, else the name itself."""
    named = files.withColumn("name", clean_name(F.col(column)))
    close = closest(named.select("name").distinct(), known, cutoff).select("name", "close")
    out = named.join(close, "name", "left")
    status = F.when(F.col("close") == F.col("name"), "exact").when(F.col("close").isNotNull(), "fuzzy").otherwise("none")
    return out.withColumn("status", status).withColumn("clean", F.coalesce("close", "name")).drop("close", "name")


def reason_counts(rejected: DataFrame, reason: str = "rejected") -> DataFrame:
    """(cause, n): refusals by cause, the numbers in their texts left out; most frequent first is the caller's order."""
    cause = F.trim(F.regexp_replace(F.regexp_replace(F.col(reason), r"[0-9]+(\.[0-9]+)?", ""), r"\s+", " "))
    return rejected.where(F.col(reason).isNotNull()).groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


def tree_match(one: DataFrame, two: DataFrame, key) -> DataFrame:
    """(path) x (path) -> path, partner, partners: the first partner under the key, and how many there are."""
    side = two.groupBy(key(F.col("path")).alias("key")).agg(F.min("path").alias("partner"), F.count("*").alias("partners"))
    return one.withColumn("key", key(F.col("path"))).join(side, "key", "left").withColumn("partners", F.coalesce("partners", F.lit(0)))


def tree_counts(one: DataFrame, two: DataFrame, key) -> DataFrame:
    """One row: matched, ambiguous, only_1, only_2."""
    got = tree_match(one, two, key)
    left = two.withColumn("key", key(F.col("path"))).join(one.select(key(F.col("path")).alias("key")), "key", "left_anti")
    return got.agg(
        F.count_if(F.col("partners") > 0).alias("matched"),
        F.count_if(F.col("partners") > 1).alias("ambiguous"),
        F.count_if(F.col("partners") == 0).alias("only_1"),
    ).crossJoin(left.agg(F.count("*").alias("only_2")))


def destinations(plan: DataFrame, dest: str = "dest", order: str = "src", taken: DataFrame | None = None) -> DataFrame:
    """``final``: the destination with ``_1``, ``_2`` before its extension so that none is used twice.

    ``taken`` lists destinations that exist already.
    """
    n = F.row_number().over(Window.partitionBy(dest).orderBy(order)) - 1
    plan = plan.withColumn("_n", n)
    if taken is not None:
        plan = plan.join(taken.select(F.col("path").alias(dest), F.lit(1).alias("_there")).distinct(), dest, "left")
        plan = plan.withColumn("_n", F.col("_n") + F.coalesce("_there", F.lit(0))).drop("_there")
    stem, end = F.regexp_replace(F.col(dest), r"(?<=[^./])\.[^./]*$", ""), F.regexp_extract(F.col(dest), r"(?<=[^./])(\.[^./]*)$", 1)
    return plan.withColumn("final", F.when(F.col("_n") == 0, F.col(dest)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), end))).drop("_n")


def number_within(df: DataFrame, keys: list[str], order: list, name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def empty_folders(folders: DataFrame, files: DataFrame) -> DataFrame:
    """(path) of folders under which no file is left."""
    parts = F.split(F.col("path"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    used = files.where(F.contains("path", F.lit("/"))).select(F.explode(above).alias("path")).distinct()
    return folders.join(used, "path", "left_anti")


def left_to_do(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key).distinct(), key, "left_anti")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def top_groups(df: DataFrame, key: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent keys; of equals, the first."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value, collided): the last value of each key, and whether an earlier one differed."""
    w = Window.partitionBy(key).orderBy(order)
    marked = df.withColumn("_was", F.lag(value).over(w))
    return marked.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(F.coalesce(F.col("_was") != F.col(value), F.lit(False))).alias("collided"))


def first_values(df: DataFrame, key: str, order: str) -> DataFrame:
    return first_wins(df, [key], [order])


def nested_paths(df: DataFrame, outer: str, inner: str, path: str) -> DataFrame:
    """(outer, groups): for each outer value an array of (inner, sorted paths)."""
    one = df.groupBy(outer, inner).agg(F.array_sort(F.collect_list(path)).alias("paths"))
    return one.groupBy(outer).agg(F.array_sort(F.collect_list(F.struct(inner, "paths"))).alias("groups"))


def best_rotation(scores: DataFrame, least_gain: float = 1.5) -> DataFrame:
    """(image_id, angle, score) -> image_id, angle: the best, if it beats upright clearly."""
    one = scores.groupBy("image_id", "angle").agg(F.sum("score").alias("score"))
    best = one.groupBy("image_id").agg(
        F.max_by(F.struct("angle", "score"), F.struct("score", -F.col("angle"))).alias("best"),
        F.coalesce(F.max(F.when(F.col("angle") == 0, F.col("score"))), F.lit(0.0)).alias("upright"),
    )
    clear = F.col("best.score") >= least_gain * F.greatest(F.col("upright"), F.lit(1.0))
    return best.select("image_id", F.when(clear, F.col("best.angle")).otherwise(0).alias("angle"))


def text_score(text: Column, confidence: Column) -> Column:
    """Evidence that text was read the right way up: confident letters."""
    from cartolink.functions.text import letters

    return F.when(letters(text) >= 2, confidence * letters(text)).otherwise(0.0)


def orientation(image: DataFrame, reported: str = "reported", probed: str = "probed") -> DataFrame:
    return image.withColumn("angle", F.coalesce(reported, probed, F.lit(0)))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """``n`` rows, the same at every run."""
    return df.orderBy(F.md5(F.concat_ws("-", F.lit(seed), F.col(key))), key).limit(n)


def shares(df: DataFrame, name: str, seconds: str) -> DataFrame:
    total = F.sum(seconds).over(Window.partitionBy())
    return df.groupBy(name).agg(F.sum(seconds).alias(seconds)).withColumn("share", F.col(seconds) / total)
