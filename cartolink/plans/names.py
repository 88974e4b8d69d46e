"""Queries: scalars over names and tokens, the taxonomy, and its lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolink.functions import text as tx
from cartolink.operators import curation
from cartolink.operators import taxonomy as tax

from .registry import query
from .views import GROUPS, LINES, groups, lines, table

NAME = """trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))), '&', ' and '),
  '[_/]+', ' ', 'g'), '[^a-z0-9&\\s:-]+', ' ', 'g'), '\\s+', ' ', 'g'), ' -:')"""
TERM = """trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '&', ' and '),
  '[_/]+', ' ', 'g'), '\\s*:\\s*', ' : ', 'g'), '\\s+', ' ', 'g'))"""
SINGULAR = """CASE WHEN length(t) > 3 AND ends_with(t, 'ies') THEN t[:-4] || 'y' WHEN length(t) > 4 AND regexp_matches(t, '[shxz]es$') THEN t[:-3]
  WHEN length(t) > 3 AND ends_with(t, 's') AND NOT ends_with(t, 'ss') THEN t[:-2] ELSE t END"""
STEMS = f"[{SINGULAR} FOR t IN string_split({{c}}, ' ') IF t <> '']"


@query(f"""WITH {LINES}, k AS (SELECT doc_id, line_no, {NAME.format(c="line")} AS name, {TERM.format(c="line")} AS term FROM lines)
SELECT doc_id, line_no, name, md5(term) AS term_md5, array_to_string({STEMS.format(c="name")}, ' ') AS stem, translate(name, '01345689', 'oleasgbg') AS fold FROM k""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = lines(spark, sf_dir).withColumn("name", tx.name_key(F.col("line")))
    return k.select("doc_id", "line_no", "name", F.md5(tx.term_key(F.col("line"))).alias("term_md5"), tx.stem_key(F.col("name")).alias("stem"), tx.digit_fold(F.col("name")).alias("fold"))


EDGES = ".:;|_-[](){}<>*=+~^`\"''"
CLEAN = "trim(trim(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' " + EDGES + "'))"


@query(f"""WITH {LINES}, w AS (SELECT doc_id, line_no, {CLEAN} AS token, (doc_id + line_no) % 10 / 10.0 AS confidence FROM lines)
SELECT doc_id, line_no, token, length(token) > 0 AND confidence >= 0.30 AND len(regexp_extract_all(token, '\\p{{L}}')) >= 2 AS kept FROM w""")
def token_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = lines(spark, sf_dir).select("doc_id", "line_no", tx.clean_token(F.col("line")).alias("token"), ((F.col("doc_id") + F.col("line_no")) % 10 / 10).alias("confidence"))
    return w.select("doc_id", "line_no", "token", tx.keep_token(F.col("token"), F.col("confidence")).alias("kept"))


@query("""WITH w AS (SELECT doc_id, unnest(list_distinct(string_split_regex(text, '\\s+'))) AS word FROM documents)
SELECT doc_id, count(*) AS words, count_if(word <> '' AND doc_id % 7 > 0 AND regexp_matches(word, '\\p{L}'))::BIGINT AS kept FROM w GROUP BY doc_id""")
def raw_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word"))
    confidence = F.when(F.col("doc_id") % 7 > 0, 50.0).otherwise(-1.0)
    return d.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_if(tx.keep_raw_word(F.col("word"), confidence)).alias("kept"))


FILES = """u AS (SELECT page_id, url, string_split(url, '/')[-1] || CASE page_id % 4 WHEN 0 THEN '_3 (2).png' WHEN 1 THEN ' a_jpg.rf.0aF9.png' WHEN 2 THEN '.JPG' ELSE '' END AS name FROM pages)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("page_id") % 4 == 0, "_3 (2).png").when(F.col("page_id") % 4 == 1, " a_jpg.rf.0aF9.png").when(F.col("page_id") % 4 == 2, ".JPG").otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat(tx.base_name(F.col("url")), end).alias("name"))


STEM = "CASE WHEN regexp_matches({c}, '[^.]\\.[^.]*$') THEN regexp_replace({c}, '([^.])\\.[^.]*$', '\\1') ELSE {c} END"
EXPORT = "_([A-Za-z0-9]+)\\.rf\\.[A-Za-z0-9]+\\.([A-Za-z0-9]+)$"


@query(f"""WITH {FILES}, s AS (SELECT *, {STEM.format(c="name")} AS stem FROM u)
SELECT page_id, coalesce(nullif(replace(trim(regexp_replace(name, '[^\\p{{L}}\\p{{N}}\\-_.() ]', '_', 'g')), ' ', '_'), ''), 'unnamed') AS safe,
  regexp_replace(lower(stem), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS key,
  coalesce(nullif(regexp_replace(regexp_replace(stem, '\\s*\\(\\d+\\)$', ''), '_\\d+$', ''), ''), stem) AS source,
  CASE WHEN regexp_matches(name, '{EXPORT}') THEN replace(regexp_replace(name, '{EXPORT}', ''), ' ', '_') || '.' || regexp_extract(name, '{EXPORT}', 2)
    ELSE replace(regexp_replace(name, '\\.[^.]*$', ''), ' ', '_') || CASE WHEN regexp_extract(name, '\\.([^.]*)$', 1) <> '' THEN '.' || regexp_extract(name, '\\.([^.]*)$', 1) ELSE '' END END AS clean,
  CASE WHEN lower(regexp_extract(name, '\\p{{L}}')) BETWEEN 'a' AND 'h' THEN 'A-H' WHEN lower(regexp_extract(name, '\\p{{L}}')) BETWEEN 'i' AND 'p' THEN 'I-P'
    WHEN lower(regexp_extract(name, '\\p{{L}}')) BETWEEN 'q' AND 'z' THEN 'Q-Z' ELSE 'Other' END AS bucket,
  lower(url) AS tree
FROM s""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("name")
    return _files(spark, sf_dir).select(
        "page_id", tx.safe_name(n).alias("safe"), tx.path_key(n).alias("key"), tx.source_name(n).alias("source"), tx.clean_export_name(n).alias("clean"),
        tx.initial_bucket(n).alias("bucket"), tx.tree_key(F.col("url")).alias("tree"),
    )


@query("""WITH b AS (SELECT CASE WHEN c BETWEEN 'a' AND 'h' THEN 'A-H' WHEN c BETWEEN 'i' AND 'p' THEN 'I-P' WHEN c BETWEEN 'q' AND 'z' THEN 'Q-Z' ELSE 'Other' END AS bucket
  FROM (SELECT lower(regexp_extract(p_name, '\\p{L}')) AS c FROM part))
SELECT bucket, count(*) AS n FROM b GROUP BY bucket""")
def initial_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(tx.initial_bucket(F.col("p_name")).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH {LINES}, p AS (SELECT doc_id, line_no, line AS b, substr(line, 1 + (line_no % 4)::INT) AS a FROM lines),
k AS (SELECT *, lower(trim(regexp_replace(a, '\\s+', ' ', 'g'))) AS x, lower(trim(regexp_replace(b, '\\s+', ' ', 'g'))) AS y FROM p)
SELECT doc_id, line_no, x <> '' AND y <> '' AND x <> y AND len(regexp_extract_all(y, '\\p{{L}}')) > len(regexp_extract_all(x, '\\p{{L}}')) AND ends_with(y, x) AS cut FROM k""")
def truncations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lines(spark, sf_dir).withColumn("a", F.expr("substr(line, 1 + cast(line_no % 4 as int))"))
    return p.select("doc_id", "line_no", tx.is_truncation(F.col("a"), F.col("line")).alias("cut"))


@query("""SELECT o_orderkey,
  coalesce(nullif(trim(CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority ELSE ' ' END), ''), o_orderstatus) AS by_legend,
  coalesce(o_orderstatus, o_orderpriority) AS by_db,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'group' END, o_orderstatus) AS by_canonical,
  CASE WHEN o_orderkey % 5 = 0 THEN 'orange' WHEN o_orderkey % 7 = 0 THEN 'blue' WHEN o_orderkey % 7 = 1 THEN 'magenta' WHEN o_orderkey % 7 = 2 THEN 'orange' ELSE 'green' END AS colour
FROM orders""")
def label_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    legend, known = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).otherwise(" "), F.col("o_orderstatus")
    group = F.when(F.col("o_orderkey") % 2 == 0, "group")
    k = F.col("o_orderkey") % 7
    method = F.when(k == 0, "phash_db").when(k == 1, "phash_db+same").when(k != 2, "legend")
    return o.select(
        "o_orderkey", tx.pick_label("legend", legend, known).alias("by_legend"), tx.pick_label("db", legend, known).alias("by_db"),
        tx.pick_label("canonical", legend, known, group).alias("by_canonical"), tx.method_colour(method, F.col("o_orderkey") % 5 > 0).alias("colour"),
    )


# -- taxonomy -------------------------------------------------------------------

INDEX = f"""{GROUPS},
keyed AS (
  SELECT {TERM.format(c="canonical")} AS key, canonical, 0 AS kind, ord, -1 AS pos FROM groups
  UNION ALL SELECT {TERM.format(c="term")}, canonical, 1, ord, pos FROM terms),
idx AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY kind, ord, pos) AS n FROM keyed WHERE key <> '') WHERE n = 1)"""


@query(f"WITH {INDEX} SELECT key, canonical, kind FROM idx")
def term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax.term_index(*groups(spark, sf_dir)).select("key", "canonical", "kind")


@query(f"""WITH {INDEX}, c AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '_') ELSE p_brand END AS class_name FROM part)
SELECT class_name, idx.canonical FROM c LEFT JOIN idx ON idx.key = {TERM.format(c="class_name")}""")
def class_to_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax.classify(_classes(spark, sf_dir), tax.term_index(*groups(spark, sf_dir)))


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("case when p_partkey % 3 = 0 then upper(p_name) when p_partkey % 3 = 1 then replace(p_name, ' ', '_') else p_brand end class_name").distinct()


@query(f"SELECT key, count(DISTINCT canonical) AS n FROM (SELECT p_type AS canonical, {TERM.format(c='p_name')} AS key FROM part) GROUP BY key HAVING count(DISTINCT canonical) > 1")
def ambiguous_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax.ambiguous(groups(spark, sf_dir)[1])


MERGED = f"""{INDEX},
mapped AS (SELECT class_name, canonical FROM (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '_') ELSE p_brand END AS class_name FROM part)
  JOIN idx ON idx.key = {TERM.format(c="class_name")}),
parts AS (
  SELECT canonical, ord, 0 AS kind, '' AS sort, 0 AS pos, canonical AS term FROM groups
  UNION ALL SELECT m.canonical, g.ord, 1, lower(class_name), 0, lower(class_name) FROM mapped m JOIN groups g ON g.canonical = m.canonical
  UNION ALL SELECT canonical, ord, 2, '', pos, term FROM terms),
pk AS (SELECT *, {TERM.format(c="term")} AS key FROM parts),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical, key ORDER BY kind, sort, pos) AS n FROM pk) WHERE n = 1),
merged AS (SELECT canonical, ord, row_number() OVER (PARTITION BY canonical ORDER BY kind, sort, pos) AS place, lower(term) AS term, key FROM once)"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, t = groups(spark, sf_dir)
    return tax.merged_terms(g, tax.classify(_classes(spark, sf_dir), tax.term_index(g, t)), t)


@query(f"WITH {MERGED} SELECT canonical, place, term, key FROM merged")
def merged_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("canonical", "place", "term", "key")


@query(f"WITH {MERGED} SELECT key, string_agg(canonical, '|' ORDER BY ord) AS groups FROM (SELECT key, canonical, min(ord) AS ord FROM merged GROUP BY ALL) GROUP BY key")
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax.search_index(_merged(spark, sf_dir)).select("key", F.array_join("groups", "|").alias("groups"))


@query(f"""WITH {MERGED}, h AS (SELECT *, CASE WHEN key = 'red' THEN 0 WHEN contains(key, 'red') OR contains('red', key) THEN 1 END AS kind FROM merged)
SELECT canonical, term, kind = 0 AS exact FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY place) AS n FROM h WHERE kind IS NOT NULL) WHERE n = 1""")
def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tax.search(_merged(spark, sf_dir), "Red")


@query("""WITH e AS (SELECT c_nationkey::BIGINT AS src, c_custkey % 25 AS dst FROM customer), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)
SELECT src, dst FROM b WHERE src <> dst AND src % 6 > 0 AND dst % 6 > 0""")
def symmetric_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "customer").selectExpr("cast(c_nationkey as bigint) src", "c_custkey % 25 dst")
    return tax.symmetric(e, table(spark, sf_dir, "nation").selectExpr("cast(n_nationkey as bigint) node").where("node % 6 > 0"))


@query(f"""WITH {INDEX}, names AS (SELECT DISTINCT p_name || ' ' || p_brand || 's' AS name FROM part),
tok AS (SELECT DISTINCT name, unnest({STEMS.format(c=NAME.format(c="name"))}) AS token FROM names),
nk AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY kind, ord, pos) AS n FROM (
    SELECT {NAME.format(c="canonical")} AS key, canonical, 0 AS kind, ord, -1 AS pos FROM groups UNION ALL SELECT {NAME.format(c="term")}, canonical, 1, ord, pos FROM terms) WHERE key <> '') WHERE n = 1),
tt AS (SELECT key, canonical, list_distinct({STEMS.format(c="key")}) AS toks FROM nk),
hit AS (SELECT name, key, canonical, len(toks) AS size FROM tt, unnest(toks) u(token) JOIN tok USING (token) GROUP BY ALL HAVING count(*) = len(toks)),
best AS (SELECT * FROM (SELECT *, max(size) OVER (PARTITION BY name) AS most FROM hit) WHERE size = most)
SELECT name, count(DISTINCT canonical) AS winners, CASE WHEN count(DISTINCT canonical) = 1 THEN min(canonical) END AS canonical FROM best GROUP BY name""")
def longest_contained_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").selectExpr("concat(p_name, ' ', p_brand, 's') name").distinct()
    return tax.contained_terms(names, tax.term_index(*groups(spark, sf_dir), tx.name_key))


@query()
def canonical_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").selectExpr("case p_partkey % 4 when 0 then upper(p_name) when 1 then concat(p_name, 's') when 2 then replace(p_name, 'o', '0') else concat(substr(p_name, 2), 'x') end name")
    return tax.canonical_names(names, *groups(spark, sf_dir))


@query()
def fuzzy_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return tax.closest(names.select(F.concat(F.expr("substr(p_name, 2)"), F.lit("e")).alias("name")), names.select(F.col("p_name").alias("key")), 0.6)


@query()
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    files = part.selectExpr("p_partkey", "case p_partkey % 3 when 0 then concat(p_name, '_png.rf.', md5(p_name), '.png') when 1 then concat(substr(p_name, 3), '.png') else concat(p_brand, ' ', p_size, p_partkey, '.jpeg') end file")
    return curation.clean_names(files, part.selectExpr("replace(p_name, ' ', '_') || '.png' as key").distinct(), "file")


@query("""WITH x AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'g' || (o_custkey % 4) END AS final, CASE WHEN o_orderkey % 2 = 0 THEN 'g' || (o_custkey % 5) END AS candidate, 'g' || (o_custkey % 7) AS legend FROM orders)
SELECT o_orderkey, coalesce(final, candidate, legend) AS canonical FROM x""")
def final_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "case when o_orderkey % 3 = 0 then concat('g', o_custkey % 4) end final", "case when o_orderkey % 2 = 0 then concat('g', o_custkey % 5) end candidate", "concat('g', o_custkey % 7) legend")
    return x.select("o_orderkey", tax.first_canonical(F.col("final"), F.col("candidate"), F.col("legend")).alias("canonical"))


@query(f"""WITH r AS (
  SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'a b' WHEN 1 THEN 'A_B' ELSE 'c' END AS a, CASE o_custkey % 2 WHEN 0 THEN 'A  B' ELSE 'd' END AS b,
    CASE WHEN o_orderkey % 4 > 0 THEN 'g' || (o_orderkey % 3) END AS ca, CASE WHEN o_custkey % 5 > 0 THEN 'g' || (o_custkey % 3) END AS cb FROM orders),
e AS (SELECT 'g0' AS src, 'g1' AS dst UNION ALL SELECT 'g1', 'g0')
SELECT o_orderkey, CASE WHEN CASE WHEN ca IS NOT NULL AND cb IS NOT NULL THEN ca = cb ELSE {NAME.format(c="a")} = {NAME.format(c="b")} END THEN 'same'
  WHEN EXISTS (SELECT 1 FROM e WHERE src = ca AND dst = cb) THEN 'related' END AS relation FROM r""")
def concept_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case o_orderkey % 3 when 0 then 'a b' when 1 then 'A_B' else 'c' end a", "case o_custkey % 2 when 0 then 'A  B' else 'd' end b",
        "case when o_orderkey % 4 > 0 then concat('g', o_orderkey % 3) end ca", "case when o_custkey % 5 > 0 then concat('g', o_custkey % 3) end cb",
    )
    e = spark.createDataFrame([("g0", "g1"), ("g1", "g0")], "src string, dst string")
    return tax.relation(r, e).select("o_orderkey", "relation")


@query(f"""WITH {MERGED}, e AS (SELECT a.canonical AS src, b.canonical AS dst FROM groups a JOIN groups b ON abs(a.ord - b.ord) = 1),
o AS (SELECT lower(class_name) AS key, string_agg(class_name, '|' ORDER BY class_name) AS classes, min_by(canonical, class_name) AS canonical FROM mapped GROUP BY 1)
SELECT key, classes, canonical, (SELECT string_agg(term, '|' ORDER BY place) FROM merged m WHERE m.canonical = o.canonical) AS same,
  coalesce((SELECT string_agg(dst, '|' ORDER BY dst) FROM e WHERE src = o.canonical), '') AS related_groups FROM o""")
def class_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, t = groups(spark, sf_dir)
    mapped = tax.classify(_classes(spark, sf_dir), tax.term_index(g, t))
    one = g.selectExpr("canonical src", "ord").join(g.selectExpr("canonical dst", "ord - 1 as ord"), "ord").select("src", "dst")
    e = one.unionByName(one.selectExpr("dst src", "src dst"))
    n = tax.neighbours(mapped, tax.merged_terms(g, mapped, t), e)
    return n.select("key", F.array_join("classes", "|").alias("classes"), "canonical", F.array_join("same", "|").alias("same"), F.array_join("related_groups", "|").alias("related_groups"))
