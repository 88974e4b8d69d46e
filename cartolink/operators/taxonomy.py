"""A taxonomy of names: groups of terms, a graph of neighbours, and lookups in both.

Groups have ``canonical, ord`` (of the group) ; terms have ``canonical, ord``
(of the group), ``pos`` (in the group) and ``term``; edges have ``src, dst``.
The taxonomy is small by nature and joins to names on equal keys, so Catalyst may
send it to all tasks or shuffle, by its measured size.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolink.functions.text import digit_fold, name_key, stem_key, stem_tokens, term_key


def first_wins(df: DataFrame, key: list[str], order: list) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def term_index(groups: DataFrame, terms: DataFrame, key=term_key) -> DataFrame:
    """(key, canonical, rank): each key's group; group names come before terms, then earlier groups."""
    names = groups.select(key(F.col("canonical")).alias("key"), "canonical", F.lit(0).alias("kind"), "ord", F.lit(-1).alias("pos"))
    rest = terms.select(key(F.col("term")).alias("key"), "canonical", F.lit(1).alias("kind"), "ord", "pos")
    both = names.unionByName(rest).where("key <> ''")
    return first_wins(both, ["key"], ["kind", "ord", "pos"])


def classify(classes: DataFrame, index: DataFrame) -> DataFrame:
    """(class_name) -> (class_name, canonical); null where no term fits."""
    keyed = classes.withColumn("key", term_key(F.col("class_name")))
    return keyed.join(index.select("key", "canonical"), "key", "left").drop("key")


def symmetric(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Both directions of every edge between known nodes, without loops, once each."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    known = nodes.select("node").distinct()
    both = both.where("src <> dst").distinct()
    return both.join(known.withColumnRenamed("node", "src"), "src", "left_semi").join(known.withColumnRenamed("node", "dst"), "dst", "left_semi")


def merged_terms(groups: DataFrame, mapped: DataFrame, terms: DataFrame) -> DataFrame:
    """(canonical, ord, place, term): a group's name, its classes, its terms; lower-cased, once by key."""
    parts = groups.select("canonical", "ord", F.lit(0).alias("kind"), F.lit("").alias("sort"), F.lit(0).alias("pos"), F.col("canonical").alias("term"))
    classes = mapped.where("canonical is not null").join(groups, "canonical")
    parts = parts.unionByName(classes.select("canonical", "ord", F.lit(1).alias("kind"), F.lower("class_name").alias("sort"), F.lit(0).alias("pos"), F.lower("class_name").alias("term")))
    parts = parts.unionByName(terms.select("canonical", "ord", F.lit(2).alias("kind"), F.lit("").alias("sort"), "pos", "term"))
    once = first_wins(parts.withColumn("key", term_key(F.col("term"))), ["canonical", "key"], ["kind", "sort", "pos"])
    place = F.row_number().over(Window.partitionBy("canonical").orderBy("kind", "sort", "pos"))
    return once.select("canonical", "ord", place.alias("place"), F.lower("term").alias("term"), "key")


def search_index(merged: DataFrame) -> DataFrame:
    """(key, groups): a term's groups in their order."""
    once = merged.groupBy("key", "canonical").agg(F.min("ord").alias("ord"))
    packed = F.array_sort(F.collect_list(F.struct("ord", "canonical")))
    return once.groupBy("key").agg(F.transform(packed, lambda g: g["canonical"]).alias("groups"))


def ambiguous(terms: DataFrame) -> DataFrame:
    """(key, n): terms in more than one group."""
    keyed = terms.select(term_key(F.col("term")).alias("key"), "canonical")
    return keyed.groupBy("key").agg(F.count_distinct("canonical").alias("n")).where("n > 1")


def search(merged: DataFrame, query: str) -> DataFrame:
    """(canonical, term, exact): each group's first hit, exact ones first, then in the groups' order.

    A group's terms are tried in order; a term hits if equal to the query, or if
    either holds the other.
    """
    q = term_key(F.lit(query))
    kind = F.when(F.col("key") == q, 0).when(F.contains("key", q) | F.contains(q, F.col("key")), 1)
    hits = first_wins(merged.withColumn("kind", kind).where("kind is not null"), ["canonical"], ["place"])
    return hits.select("canonical", "term", (F.col("kind") == 0).alias("exact"), "ord").orderBy("kind", "ord").drop("ord")


def neighbours(mapped: DataFrame, merged: DataFrame, edges: DataFrame) -> DataFrame:
    """One row for each lower-cased class: classes, canonical, same, related_groups, related."""
    own = mapped.where("canonical is not null").withColumn("key", F.lower("class_name"))
    first = own.groupBy("key").agg(F.array_sort(F.collect_list("class_name")).alias("classes"), F.min_by("canonical", "class_name").alias("canonical"))
    same = merged.groupBy("canonical").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "term"))), lambda t: t["term"]).alias("same"))
    near = edges.select(F.col("src").alias("canonical"), F.col("dst").alias("near"))
    groups = near.groupBy("canonical").agg(F.array_sort(F.collect_set("near")).alias("related_groups"))
    names = near.select("canonical", "near", F.lit(0).alias("kind"), F.col("near").alias("term"))
    names = names.unionByName(near.join(own.select(F.col("canonical").alias("near"), "key"), "near").select("canonical", "near", F.lit(1).alias("kind"), F.col("key").alias("term")))
    names = first_wins(names.withColumn("tk", term_key(F.col("term"))), ["canonical", "tk"], ["near", "kind", "term"])
    related = names.groupBy("canonical").agg(F.transform(F.array_sort(F.collect_list(F.struct("near", "kind", "term"))), lambda t: t["term"]).alias("related"))
    out = first.join(same, "canonical", "left").join(groups, "canonical", "left").join(related, "canonical", "left")
    empty = F.array().cast("array<string>")
    return out.select("key", "classes", "canonical", "same", *[F.coalesce(c, empty).alias(c) for c in ("related_groups", "related")])


# -- the ladder -----------------------------------------------------------------


def contained_terms(names: DataFrame, index: DataFrame) -> DataFrame:
    """(name, canonical, winners) by the longest term all of whose stem tokens a name has.

    canonical is null where the longest terms are of several groups.
    """
    tokens = names.select("name", F.explode(F.array_distinct(stem_tokens(name_key(F.col("name"))))).alias("token")).distinct()
    terms = index.select("key", "canonical", F.array_distinct(stem_tokens(F.col("key"))).alias("all"))
    terms = terms.select("key", "canonical", F.size("all").alias("size"), F.explode("all").alias("token"))
    hits = tokens.join(terms, "token").groupBy("name", "key", "canonical", "size").agg(F.count("*").alias("n")).where("n = size")
    longest = hits.withColumn("most", F.max("size").over(Window.partitionBy("name"))).where("size = most")
    return longest.groupBy("name").agg(F.count_distinct("canonical").alias("winners"), F.min("canonical").alias("canonical")).withColumn("canonical", F.when(F.col("winners") == 1, F.col("canonical")))


@F.pandas_udf(T.DoubleType())
def likeness(name: pd.Series, key: pd.Series) -> pd.Series:
    """Share of characters in matching blocks, of the key against the name."""
    one = difflib.SequenceMatcher()
    out = []
    for n, k in zip(name, key, strict=True):
        if one.b != n:
            one.set_seq2(n)
        one.set_seq1(k)
        out.append(one.ratio())
    return pd.Series(out, dtype="float64")


def closest(names: DataFrame, keys: DataFrame, cutoff: float, column: str = "name", out: str = "close") -> DataFrame:
    """The key (column ``key``) most similar to each name by matching blocks, at least ``cutoff``; the greater of equals.

    Nothing is collected: names meet keys by length, as lengths alone bound the measure, and only where
    the letters that both have could reach the cutoff are blocks matched.  A key equal to a name is found first.
    """
    share, text = float(cutoff), F.col(column)
    wanted = names.where(F.length(text) > 0).select(column).distinct()
    known = keys.select("key").distinct()
    exact = wanted.join(known.withColumnRenamed("key", column), column).select(column, text.alias(out))
    rest = wanted.join(exact.select(column), column, "left_anti").withColumn("length", F.length(text))
    low = F.ceil(F.col("length") * share / (2 - share) - 1e-9).cast("int")
    high = F.floor(F.col("length") * (2 - share) / share + 1e-9).cast("int") if share else F.lit(10**6)
    rest = rest.withColumn("length", F.explode(F.sequence(F.greatest(low, F.lit(1)), F.greatest(high, F.lit(1)))))
    pairs = rest.join(known.withColumn("length", F.length("key")), "length")
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    # Letters of the name that the key has nowhere can't match, nor the other way round.
    common = lambda a, b: F.size(F.filter(letters(a), lambda x: F.contains(b, x)))
    most = F.least(common(text, F.col("key")), common(F.col("key"), text))
    pairs = pairs.where(2 * most >= share * (F.length(text) + F.length("key")) - 1e-9)
    scored = pairs.select(column, "key", likeness(text, F.col("key")).alias("ratio")).where(F.col("ratio") >= share)
    best = scored.groupBy(column).agg(F.max(F.struct("ratio", "key")).alias("best")).select(column, F.col("best.key").alias(out))
    return names.join(exact.unionByName(best), column, "left")


def canonical_names(names: DataFrame, groups: DataFrame, terms: DataFrame, cutoff: float = 0.88) -> DataFrame:
    """(name) -> (name, canonical) by the first rung that answers.

    Exact key; singular; digits as letters; the longest contained term, where a tie
    of groups ends the search without an answer; closest key.
    """
    index = term_index(groups, terms, name_key)
    stems = first_wins(index.withColumn("stem", stem_key(F.col("key"))), ["stem"], ["kind", "ord", "pos"]).select("stem", F.col("canonical").alias("by_stem"))
    exact = index.select("key", F.col("canonical").alias("by_key"))
    rows = names.select("name").distinct().withColumn("key", name_key(F.col("name"))).withColumn("stem", stem_key(F.col("key")))
    rows = rows.withColumn("fold", digit_fold(F.col("key"))).withColumn("fold_stem", stem_key(name_key(F.col("fold"))))
    rows = rows.join(exact, "key", "left").join(stems, "stem", "left")
    rows = rows.join(exact.select(F.col("key").alias("fold"), F.col("by_key").alias("by_fold")), "fold", "left")
    rows = rows.join(stems.select(F.col("stem").alias("fold_stem"), F.col("by_stem").alias("by_fold_stem")), "fold_stem", "left")
    folded = F.when(F.col("fold_stem") != F.col("stem"), F.coalesce("by_fold", "by_fold_stem"))
    rows = rows.withColumn("sure", F.when(F.col("key") != "", F.coalesce("by_key", "by_stem", folded)))
    held = contained_terms(rows.where("sure is null").select("name"), index).select("name", "winners", F.col("canonical").alias("held"))
    rows = rows.join(held, "name", "left")
    if cutoff < 1:
        last = rows.where("sure is null and winners is null and key <> ''").select("key").distinct()
        close = closest(last.withColumnRenamed("key", "name"), exact.select("key"), cutoff).withColumnRenamed("name", "key").where("close is not null")
        close = close.join(exact.select(F.col("key").alias("close"), F.col("by_key").alias("by_close")), "close").select("key", "by_close")
        rows = rows.join(close, "key", "left")
    else:
        rows = rows.withColumn("by_close", F.lit(None).cast("string"))
    guess = F.when(F.col("winners").isNull(), F.col("by_close")).otherwise(F.col("held"))
    return rows.select("name", F.coalesce("sure", guess).alias("canonical"))


def first_canonical(final: Column, candidate: Column, legend: Column) -> Column:
    """The canonical name of a result: of its final class, else the database's candidate, else the legend's name."""
    return F.coalesce(final, candidate, legend)


def resolved(canonical: Column, name: Column) -> Column:
    return F.coalesce(canonical, F.nullif(name_key(name), F.lit("")))


def relation(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b, ca, cb) with the canonical names -> ``relation``: same, related or null.

    Equal groups are the same; names without a group are if their keys are equal.
    """
    linked = edges.select(F.col("src").alias("ca"), F.col("dst").alias("cb")).distinct().withColumn("linked", F.lit(True))
    same = F.when(F.col("ca").isNotNull() & F.col("cb").isNotNull(), F.col("ca") == F.col("cb")).otherwise(name_key(F.col("a")) == name_key(F.col("b")))
    same = same & (F.length("a") > 0) & (F.length("b") > 0)
    out = pairs.join(linked, ["ca", "cb"], "left")
    return out.withColumn("relation", F.when(same, "same").when(F.col("linked"), "related")).drop("linked")
