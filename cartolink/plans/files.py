"""Queries: matching file lists, plans, counts and other set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartolink.functions.text import base_name, is_word, letters, tree_key
from cartolink.operators import curation, decide
from cartolink.sources.files import collect_names, reported_angle
from cartolink.sources.sinks import report_lines

from .registry import query
from .search import CASCADE_STAGES
from .views import TIES, decisions, table


@query("""WITH m AS (SELECT p_partkey, p_name || '/' || p_brand || CASE p_partkey % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' ELSE '' END AS path FROM part),
l AS (SELECT DISTINCT 'legends/' || CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN lower(p_brand) ELSE replace(p_brand, '#', '_') END || '.jpg' AS path FROM part WHERE p_size < 40),
ls AS (SELECT path, regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', '') AS stem FROM l),
ms AS (SELECT *, regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', '') AS stem FROM m),
e AS (SELECT stem, min(path) AS p FROM ls GROUP BY stem), k AS (SELECT regexp_replace(lower(stem), '[^\\p{L}\\p{N}]', '', 'g') AS key, min(path) AS p FROM ls GROUP BY 1)
SELECT p_partkey, path, coalesce(e.p, k.p) AS partner FROM ms LEFT JOIN e USING (stem) LEFT JOIN k ON k.key = regexp_replace(lower(ms.stem), '[^\\p{L}\\p{N}]', '', 'g')""")
def two_phase_stem_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    m = part.selectExpr("p_partkey", "concat(p_name, '/', p_brand, case p_partkey % 3 when 0 then '.png' when 1 then '.JPG' else '' end) path")
    name = "case p_size % 3 when 0 then p_brand when 1 then lower(p_brand) else replace(p_brand, '#', '_') end"
    l = part.where("p_size < 40").selectExpr(f"concat('legends/', {name}, '.jpg') path").distinct()  # noqa: E741
    return curation.find_partner(m, l)


TREES = """a AS (SELECT source || '/' || (doc_id % 400) || '.PNG' AS path FROM documents), b AS (SELECT 'src' || (doc_id % 19) || '/' || (doc_id % 300) || '.png' AS path FROM labels)"""


def _trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, sf_dir, "documents").selectExpr("concat(source, '/', doc_id % 400, '.PNG') path")
    return a, table(spark, sf_dir, "labels").selectExpr("concat('src', doc_id % 19, '/', doc_id % 300, '.png') path")


@query(f"""WITH {TREES}, k AS (SELECT lower(path) AS key, min(path) AS partner, count(*) AS partners FROM b GROUP BY 1)
SELECT path, partner, coalesce(partners, 0) AS partners FROM a LEFT JOIN k ON k.key = lower(a.path)""")
def tree_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.tree_match(*_trees(spark, sf_dir), tree_key).select("path", "partner", "partners")


@query(f"""WITH {TREES}, ka AS (SELECT regexp_replace(lower(string_split(path, '/')[-1]), '\\.[^.]*$', '') AS key FROM a), kb AS (SELECT regexp_replace(lower(string_split(path, '/')[-1]), '\\.[^.]*$', '') AS key FROM b),
n AS (SELECT key, count(*) AS n FROM kb GROUP BY key)
SELECT (SELECT count(*) FROM ka JOIN n USING (key)) AS matched, (SELECT count(*) FROM ka JOIN n USING (key) WHERE n.n > 1) AS ambiguous,
  (SELECT count(*) FROM ka WHERE key NOT IN (SELECT key FROM n)) AS only_1, (SELECT count(*) FROM kb WHERE key NOT IN (SELECT key FROM ka)) AS only_2""")
def tree_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.tree_counts(*_trees(spark, sf_dir), lambda p: tree_key(p, by="name", ignore_type=True))


@query(f"WITH {TREES} SELECT DISTINCT lower(path) AS key FROM a INTERSECT SELECT lower(path) FROM b")
def tree_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _trees(spark, sf_dir)
    return a.select(tree_key(F.col("path")).alias("key")).intersect(b.select(tree_key(F.col("path")).alias("key")))


@query("""SELECT h AS hash, max_by(source, doc_id) AS source, bool_or(coalesce(was <> source, false)) AS collided FROM (
  SELECT *, lag(source) OVER (PARTITION BY h ORDER BY doc_id) AS was FROM (SELECT doc_id, source, md5(text) AS h FROM documents)) GROUP BY h""")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("hash"))
    return curation.last_wins(d, "hash", "source", "doc_id")


@query("SELECT hash, min(doc_id) AS doc_id FROM (SELECT doc_id, md5(text) AS hash FROM documents) GROUP BY hash")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))
    return curation.first_values(d, "hash", "doc_id").select("hash", "doc_id")


@query("""WITH p AS (SELECT p_partkey AS src, 'out/' || p_name || '.png' AS dest FROM part), t AS (SELECT DISTINCT 'out/' || p_name || '.png' AS dest FROM part WHERE p_size > 45),
n AS (SELECT p.*, row_number() OVER (PARTITION BY dest ORDER BY src) - 1 + CASE WHEN t.dest IS NULL THEN 0 ELSE 1 END AS n FROM p LEFT JOIN t USING (dest))
SELECT src, dest, CASE WHEN n = 0 THEN dest ELSE regexp_replace(dest, '\\.png$', '') || '_' || n || '.png' END AS final FROM n""")
def destination_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").selectExpr("p_partkey src", "concat('out/', p_name, '.png') dest")
    taken = table(spark, sf_dir, "part").where("p_size > 45").selectExpr("concat('out/', p_name, '.png') path")
    return curation.destinations(p, taken=taken)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_returnflag || '/' || l_orderkey || '_' || row_number() OVER (
  PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS name FROM lineitem""")
def number_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curation.number_within(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], TIES[1:])
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", F.concat("l_returnflag", F.lit("/"), "l_orderkey", F.lit("_"), "n").alias("name"))


@query("""WITH f AS (SELECT DISTINCT source || '/' || lang AS path FROM documents UNION SELECT DISTINCT source FROM documents),
k AS (SELECT DISTINCT source || '/' || lang AS d, source AS s FROM documents WHERE doc_id % 37 = 0)
SELECT path FROM f WHERE path NOT IN (SELECT d FROM k UNION SELECT s FROM k)""")
def empty_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    folders = d.select(F.concat_ws("/", "source", "lang").alias("path")).unionByName(d.select(F.col("source").alias("path"))).distinct()
    return curation.empty_folders(folders, d.where("doc_id % 37 = 0").select(F.concat_ws("/", "source", "lang", "doc_id").alias("path")))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def left_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.left_to_do(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.status_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "status"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 15")
def top_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.top_groups(table(spark, sf_dir, "events"), "user_id", 15)


@query("""SELECT conv_id, string_agg(role || ':' || turns, ';' ORDER BY role) AS groups FROM (
  SELECT conv_id, role, string_agg(turn, ',' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id, role) GROUP BY conv_id""")
def nested_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = curation.nested_paths(table(spark, sf_dir, "conversations"), "conv_id", "role", "turn")
    one = F.transform("groups", lambda g: F.concat(g["role"], F.lit(":"), F.array_join(g["paths"].cast("array<string>"), ",")))
    return n.select("conv_id", F.array_join(one, ";").alias("groups"))


@query("""WITH t AS (SELECT o_custkey AS image_id, (o_orderkey % 4 * 90)::INT AS angle,
    CASE WHEN len(regexp_extract_all(o_orderpriority, '\\p{L}')) >= 2 THEN (o_orderkey % 10 + 1) / 10.0::DOUBLE * len(regexp_extract_all(o_orderpriority, '\\p{L}')) ELSE 0 END AS score FROM orders),
s AS (SELECT image_id, angle, round(sum(score), 6) AS score FROM t GROUP BY ALL),
b AS (SELECT image_id, arg_max(angle, score * 1000000 - angle / 1000.0) AS angle, max(score) AS score, coalesce(max(score) FILTER (angle = 0), 0) AS upright FROM s GROUP BY image_id)
SELECT image_id, CASE WHEN score >= 1.5 * greatest(upright, 1.0) THEN angle ELSE 0 END AS angle FROM b""")
def best_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders")
    score = curation.text_score(F.col("o_orderpriority"), (F.col("o_orderkey") % 10 + 1) / 10)
    one = t.select(F.col("o_custkey").alias("image_id"), (F.col("o_orderkey") % 4 * 90).cast("int").alias("angle"), score.alias("score"))
    return curation.best_rotation(one.groupBy("image_id", "angle").agg(F.round(F.sum("score"), 6).alias("score")))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 / 10.0 >= 0.5 THEN (o_orderkey % 5 * 90 % 360)::INT WHEN o_custkey % 2 = 0 THEN 180 ELSE 0 END AS angle FROM orders""")
def orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    report = F.concat(F.lit("Rotate: "), F.col("o_orderkey") % 5 * 90, F.lit("\nOrientation confidence: "), F.col("o_orderkey") % 10 / 10)
    got = reported_angle(o.select(F.col("o_orderkey").alias("image_id"), report.alias("report")))
    both = o.join(got.withColumnRenamed("image_id", "o_orderkey").withColumnRenamed("angle", "reported"), "o_orderkey")
    return curation.orientation(both.withColumn("probed", F.when(F.col("o_custkey") % 2 == 0, 180))).select("o_orderkey", F.col("angle").cast("int").alias("angle"))


@query("SELECT event_type AS step, round(sum(value), 4) AS seconds, round(sum(value) / (SELECT sum(value) FROM events), 6) AS share FROM events GROUP BY event_type")
def timing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = curation.shares(table(spark, sf_dir, "events").selectExpr("event_type step", "value seconds"), "step", "seconds")
    return s.select("step", F.round("seconds", 4).alias("seconds"), F.round("share", 6).alias("share"))


@query("SELECT DISTINCT name FROM (SELECT trim(p_name) AS name FROM part UNION ALL SELECT trim(p_brand) FROM part) WHERE name <> ''")
def collected_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return collect_names(p.select(F.col("p_name").alias("name")), p.select(F.concat(F.lit(" "), "p_brand").alias("name")))


@query("SELECT label AS class_name, count(*) AS n, (SELECT count(DISTINCT label) FROM embeddings) AS classes FROM embeddings GROUP BY label")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    counts = e.groupBy(F.col("label").alias("class_name")).agg(F.count("*").alias("n"))
    return counts.withColumn("classes", F.count("*").over(Window.partitionBy()))


@query("SELECT count(*) AS words, count_if(len(regexp_extract_all(p_name, '\\p{L}')) >= 2)::BIGINT AS real, sum(len(regexp_extract_all(p_name, '\\p{L}')))::BIGINT AS letters FROM part")
def letter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.agg(F.count("*").alias("words"), F.count_if(is_word(F.col("p_name"))).alias("real"), F.sum(letters(F.col("p_name"))).alias("letters"))


@query("SELECT vec_id, label FROM embeddings ORDER BY md5('7-' || vec_id), vec_id LIMIT 100")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.seeded_sample(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", 100)


@query(f"""WITH x AS ({CASCADE_STAGES})
SELECT concat_ws('-', {", ".join(TIES[:4])}) AS key,
  concat_ws(chr(10), 'known: ' || coalesce(db_class, '-') || ' (nearest ' || coalesce(nearest_name, '-') || ', ' || coalesce(nearest_bits::VARCHAR, '-') || ' bits)',
    'legend: ' || coalesce(legend_name, '-') || ' score ' || printf('%.3f', ls) || ' margin ' || printf('%.3f', lm),
    'related: ' || coalesce(sem_name, '-') || ' (' || coalesce(relation, '-') || ')',
    'FINAL: ' || final_class || ' by ' || coalesce(match_method, '-')) AS report FROM x""")
def stage_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines(decide.decide_class(decisions(spark, sf_dir)).withColumn("key", F.concat_ws("-", *TIES[:4])))


@query("""SELECT string_split(url, '/')[-1] AS name, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) > 1""")
def repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(base_name(F.col("url")).alias("name")).agg(F.count("*").alias("n")).where("n > 1")
