"""Tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, one_file: bool = False) -> None:
    """One object a line, text as it is.  one_file: for small results."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_exemplars(df: DataFrame, path: str) -> None:
    """Sorted by class within files, so that a class's rows are read from few row groups."""
    df.sortWithinPartitions("class_name").write.mode("overwrite").parquet(path)


def write_hashes(df: DataFrame, path: str) -> None:
    """(class_name, file, hash) as one JSON object a class."""
    nested = df.groupBy("class_name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("file", "hash")))).alias("files"))
    nested.write.mode("overwrite").json(path)


def write_reports(df: DataFrame, path: str) -> None:
    """(name, report): one folder a name holds its text."""
    df.select("name", F.col("report").alias("value")).write.mode("overwrite").partitionBy("name").text(path)


#: The files of a taxonomy.
TAXONOMY = ("icon_class_synonyms", "class_to_canonical", "canonical_to_classes", "search_index", "icon_class_related", "icon_class_neighbors")


def write_taxonomy(tables: dict[str, DataFrame], path: str) -> None:
    """The tables of a taxonomy, a folder each below ``path``; all six names have to be there."""
    if missing := set(TAXONOMY) - set(tables):
        raise ValueError(f"no table for {sorted(missing)}")
    for name in TAXONOMY:
        write_json(tables[name], f"{path}/{name}", one_file=True)


def apply_plan(plan: DataFrame, transfer) -> None:
    """Call ``transfer(src, final)`` for every row, in the tasks.  A lost task is run again: it must be idempotent."""

    def run(rows) -> None:
        for row in rows:
            transfer(row["src"], row["final"])

    plan.select("src", "final").foreachPartition(run)


def report_lines(decisions: DataFrame) -> DataFrame:
    """(key, report): how each decision came about, a line a stage."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    stage = [
        F.format_string("known: %s (nearest %s, %s bits)", text("db_class"), text("nearest_name"), text("nearest_bits")),
        F.format_string("legend: %s score %.3f margin %.3f", text("legend_name"), F.col("legend_score"), F.col("legend_margin")),
        F.format_string("related: %s (%s)", text("sem_name"), text("relation")),
        F.format_string("FINAL: %s by %s", F.col("final_class"), text("match_method")),
    ]
    return decisions.select("key", F.concat_ws("\n", *stage).alias("report"))
