"""Inputs for the library's operators, derived from the star schema with integer arithmetic.

Each view is given twice, as a DataFrame and as SQL, so that a query and its SQL
begin from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of 'images' of ten orders; ``odd`` ones are tokens, the others icons.

    ``n`` numbers an image's boxes; rows that agree in everything share no number.
    """
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey div 10 as image_id",
        "cast((l_partkey * 37) % 900 as int) x1",
        "cast(l_linenumber * 40 + l_suppkey % 7 as int) y1",
        "cast(20 + l_partkey % 60 as int) w",
        "cast(24 + l_suppkey % 10 as int) h",
        "l_partkey % 2 = 1 as odd",
        "concat(chr(cast(65 + l_partkey % 26 as int)), 'a', chr(cast(97 + l_suppkey % 26 as int))) text",
        "(50 + l_suppkey % 50) / 100.0D as confidence",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
    )
    order = ", ".join(TIES)
    return rows.selectExpr("image_id", "x1", "y1", "x1 + w as x2", "y1 + h as y2", "odd", "text", "confidence", f"row_number() over (partition by image_id order by {order}) as n")


TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"]

BOXES = f"""
raw AS (
  SELECT l_orderkey // 10 AS image_id, ((l_partkey * 37) % 900)::INT AS x1, (l_linenumber * 40 + l_suppkey % 7)::INT AS y1,
         (20 + l_partkey % 60)::INT AS w, (24 + l_suppkey % 10)::INT AS h, l_partkey % 2 = 1 AS odd,
         chr((65 + l_partkey % 26)::INT) || 'a' || chr((97 + l_suppkey % 26)::INT) AS text,
         (50 + l_suppkey % 50) / 100.0::DOUBLE AS confidence,
         row_number() OVER (PARTITION BY l_orderkey // 10 ORDER BY {", ".join(TIES)}) AS n
  FROM lineitem),
boxes AS (SELECT image_id, x1, y1, x1 + w AS x2, y1 + h AS y2, odd, text, confidence, n FROM raw),
icons AS (SELECT image_id, n AS det_id, x1, y1, x2, y2 FROM boxes WHERE NOT odd),
tokens AS (SELECT image_id, n AS tok_id, text, confidence, x1, y1, x2, y2 FROM boxes WHERE odd)
"""


def icons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where("not odd").selectExpr("image_id", "n as det_id", "x1", "y1", "x2", "y2")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where("odd").selectExpr("image_id", "n as tok_id", "text", "confidence", "x1", "y1", "x2", "y2")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line) of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


LINES = """lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)
"""


def groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A taxonomy of part types: groups are types, terms the names of their parts and the names' words."""
    part = table(spark, sf_dir, "part")
    types = part.selectExpr("p_type as canonical").distinct().selectExpr("canonical", "row_number() over (order by canonical) as ord")
    names = part.selectExpr("p_type as canonical", "p_name as term").distinct()
    terms = names.join(types, "canonical").selectExpr("canonical", "ord", "row_number() over (partition by canonical order by term) as pos", "term")
    return types, terms


GROUPS = """
groups AS (SELECT canonical, row_number() OVER (ORDER BY canonical) AS ord FROM (SELECT DISTINCT p_type AS canonical FROM part)),
terms AS (
  SELECT canonical, ord, row_number() OVER (PARTITION BY canonical ORDER BY term) AS pos, term
  FROM (SELECT DISTINCT p_type AS canonical, p_name AS term FROM part) JOIN groups USING (canonical))
"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of the decision cascade; every branch occurs."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *TIES,
        "concat('det', l_linenumber) as original_class",
        "case when l_suppkey % 3 = 0 then concat('db', l_suppkey % 5) end as db_class",
        "case when l_suppkey % 3 < 2 then concat('db', l_suppkey % 5) end as nearest_name",
        "cast(l_partkey % 80 as int) as nearest_bits",
        "cast(l_partkey % 4 as int) as n_legend",
        "case when l_partkey % 4 > 0 then concat('leg', l_partkey % 7) end as legend_name",
        "round(0.3D + l_discount * 5, 4) as score",
        "round(0.3D + l_tax * 4, 4) as second",
        "case when l_partkey % 4 > 0 and l_returnflag <> 'N' then concat('leg', l_partkey % 7 + l_linenumber % 2) end as sem_name",
        "case when l_partkey % 4 > 0 and l_returnflag <> 'N' then round(0.3D + l_tax * 3, 4) end as sem_score",
        "case when l_partkey % 4 > 0 and l_returnflag <> 'N' then cast(1 + l_linenumber % 2 as int) end as sem_rank",
        "case when l_partkey % 4 > 0 then case l_returnflag when 'A' then 'same' when 'R' then 'related' end end as found_relation",
    )


DECISIONS = f"""d AS (
  SELECT {", ".join(TIES)}, 'det' || l_linenumber AS original_class,
    CASE WHEN l_suppkey % 3 = 0 THEN 'db' || (l_suppkey % 5) END AS db_class,
    CASE WHEN l_suppkey % 3 < 2 THEN 'db' || (l_suppkey % 5) END AS nearest_name,
    (l_partkey % 80)::INT AS nearest_bits, (l_partkey % 4)::INT AS n_legend,
    CASE WHEN l_partkey % 4 > 0 THEN 'leg' || (l_partkey % 7) END AS legend_name,
    round(0.3::DOUBLE + l_discount * 5, 4) AS score, round(0.3::DOUBLE + l_tax * 4, 4) AS second,
    CASE WHEN l_partkey % 4 > 0 AND l_returnflag <> 'N' THEN 'leg' || (l_partkey % 7 + l_linenumber % 2) END AS sem_name,
    CASE WHEN l_partkey % 4 > 0 AND l_returnflag <> 'N' THEN round(0.3::DOUBLE + l_tax * 3, 4) END AS sem_score,
    CASE WHEN l_partkey % 4 > 0 AND l_returnflag <> 'N' THEN (1 + l_linenumber % 2)::INT END AS sem_rank,
    CASE WHEN l_partkey % 4 > 0 THEN CASE l_returnflag WHEN 'A' THEN 'same' WHEN 'R' THEN 'related' END END AS found_relation
  FROM lineitem)"""
