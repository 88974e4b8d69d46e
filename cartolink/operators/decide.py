"""The cascade that reconciles a database class, a legend and a synonym graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartolink.functions.text import pick_label


@dataclass(frozen=True)
class Gates:
    floor: float = 0.60
    margin: float = 0.08
    rescue: bool = True
    rescue_floor: float = 0.35
    rescue_bits: int = 40
    related_must_win: bool = True
    naming: str = "legend"


def semantic_row(candidates: DataFrame, key: list[str]) -> DataFrame:
    """(key, rank, name, score, relation) -> the first row that means the same, else the first related one."""
    w = Window.partitionBy(*key).orderBy(F.when(F.col("relation") == "same", 0).otherwise(1), "rank")
    return candidates.where("relation in ('same', 'related')").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def decide_class(rows: DataFrame, gates: Gates = Gates()) -> DataFrame:
    """One decision a row.

    In: original_class, db_class, nearest_name, nearest_bits, n_legend (entries),
    legend_name, score, second (of the best two entries), sem_name, sem_score,
    sem_rank, found_relation, canonical (for the naming policy ``canonical``).
    Adds final_class, match_method, renamed, relation, relation_rejected, rescued,
    passes_floor and passes_margin.
    """
    none = F.lit(None).cast("string")
    has = F.col("n_legend") > 0
    score = F.when(has, F.col("score")).otherwise(-1.0)
    margin = score - F.when(F.col("n_legend") > 1, F.col("second")).otherwise(0.0)
    rows = rows.withColumn("legend_score", score).withColumn("legend_margin", margin)
    rows = rows.withColumn("passes_floor", has & (F.col("legend_score") >= gates.floor))
    rows = rows.withColumn("passes_margin", (F.col("n_legend") < 2) | (F.col("legend_margin") >= gates.margin))
    why = none
    if gates.related_must_win:
        why = F.when(
            F.col("found_relation") == "related",
            F.when(~has | (F.coalesce("sem_rank", F.lit(0)) != 1), "not the best").when(~F.col("passes_floor"), "below floor").when(~F.col("passes_margin"), "below margin"),
        )
    rows = rows.withColumn("relation_rejected", why)
    rows = rows.withColumn("relation", F.when(F.col("relation_rejected").isNull(), F.col("found_relation")))
    same = F.coalesce(F.col("relation") == "same", F.lit(False))
    wins = F.col("passes_floor") & F.col("passes_margin")
    rescued = F.lit(gates.rescue) & F.col("db_class").isNull() & same & ~wins
    rescued = rescued & F.coalesce((F.col("sem_score") >= gates.rescue_floor) & (F.col("nearest_bits") <= gates.rescue_bits), F.lit(False))
    rows = rows.withColumn("rescued", rescued)

    canonical = F.col("canonical") if "canonical" in rows.columns else None
    label = lambda legend, known: pick_label(gates.naming, F.col(legend), F.col(known), canonical)
    known, related = F.col("db_class").isNotNull(), F.col("relation").isNotNull()
    agrees = same & (F.col("sem_name") == F.col("legend_name"))
    final = (
        F.when(known & related, label("sem_name", "db_class"))
        .when(known, F.col("db_class"))
        .when(wins & agrees, label("legend_name", "nearest_name"))
        .when(wins, F.col("legend_name"))
        .when(F.col("rescued"), label("sem_name", "nearest_name"))
        .otherwise(F.col("original_class"))
    )
    method = (
        F.when(known & related, F.concat(F.lit("phash_db+"), F.col("relation")))
        .when(known, "phash_db")
        .when(wins & agrees, "legend+synonym")
        .when(wins, "legend")
        .when(F.col("rescued"), "synonym_agree")
    )
    return rows.withColumn("final_class", final).withColumn("match_method", method).withColumn("renamed", F.col("match_method").isNotNull())
