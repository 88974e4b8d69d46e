"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; what it returns is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.  As a
stage begins when the one before it has been written, it deletes that one's
intermediate tables, and no others.

Decisions come back to rows by a key of the row, not by ``doc_id``: rows with a null
id and rows that share an id are decided one by one.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartolink.llm import decontaminate, fuzzy_lines, mix, partenum, quality
from cartolink.llm.staging import Sieve, release, staged, without, work

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(number: int):
    """What a stage stages is its own, and goes as the next one of this folder begins or the run ends."""

    def wrapped(f):
        @wraps(f)
        def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            release(spark, ("pipeline", sf_dir, number - 1))
            with work(("pipeline", sf_dir, number)):
                return f(spark, docs, sf_dir)

        return begun

    return wrapped


@stage(1)
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(COLUMNS), model).where(F.col("score") >= quality.THRESHOLD).select(COLUMNS)


@stage(2)
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which no line is left."""
    rows = fuzzy_lines.dedup(docs.select(COLUMNS)).where("n_removed = 0 or n_removed < n_lines")
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


@stage(3)
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id.

    Shingles of five words, similarity 0.8.  A null id comes after all others.  Of rows
    equal in id and text one stays, unless they have no words.
    """
    rows = docs.select(*COLUMNS, fuzzy_lines.row_key().alias("row"))
    groups = partenum.jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"), n=5, num=80, den=100)
    nodes = groups.groupBy(F.col("doc_id").alias("row"), F.col("component_id").alias("root")).agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    nodes = staged(nodes.join(rows.select("row", "doc_id").distinct(), "row"), "near-nodes")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    # Only groups of several nodes lose any; the others are not listed again.
    first = nodes.groupBy("root").agg(F.min(place).alias("kept"), F.count("*").alias("nodes")).where("nodes > 1")
    gone = staged(nodes.join(first, "root").where("row <> kept.row").select("row"), "near-gone")
    left = without(rows, gone, "row")
    # Repeated rows of one key: all but the first go.
    several = staged(nodes.where("copies > 1 and n > 0").select("row"), "near-several")
    may = Sieve(several, "row").may(F.col("row"))
    doubtful = left.where(may).join(several.withColumn("repeats", F.lit(True)), "row", "left")
    single = doubtful.where("repeats is null")
    one = doubtful.where("repeats").groupBy("row").agg(F.min(F.struct("source", "lang", "n_chars", "doc_id", "text")).alias("one")).select("one.*")
    return left.where(~may).select(COLUMNS).unionByName(single.select(COLUMNS)).unionByName(one.select(COLUMNS))


@stage(4)
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = docs.select(*COLUMNS, fuzzy_lines.row_key().alias("row"))
    found = decontaminate.contaminated(rows.select(F.col("row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = staged(found.select(F.col("doc_id").alias("row")).distinct(), "clean-gone")
    return without(rows, gone, "row").select(COLUMNS)


@stage(5)
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words that it takes of each; repeats count.

    Rows equal in all columns are told apart by their number.
    """
    sizes = ["size", "source_size", "target", "taken"]
    rows = docs.select(*COLUMNS, F.xxhash64(fuzzy_lines.row_key(), "source", F.col("source").isNull(), "lang", F.col("lang").isNull(), "n_chars", F.col("n_chars").isNull()).alias("row"))
    placed = mix.mix(rows, carry=("row",)).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("taken", *sizes[:3])), False).alias("all"))
    # A key's rows have one size and source; the first of them get the most.
    number = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    both = rows.withColumn("number", number).join(placed.where("all[0].taken > 0"), "row").withColumn("one", F.get("all", F.col("number") - 1))
    return both.where("one.taken > 0").select(*COLUMNS, *[F.col(f"one.{c}").alias(c) for c in sizes])


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix_sources),
]

#: A fitted classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = staged(step(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    release(spark, ("pipeline", sf_dir, len(STAGES)))
    return docs
