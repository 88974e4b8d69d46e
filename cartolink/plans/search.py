"""Queries: retrieval, votes, gates, ranks and the decision cascade."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolink.functions.bits import combined, cosine, hamming, hamming_word, hex_words, sign_bits, weighted_similarity
from cartolink.operators import decide, retrieval

from .registry import query
from .views import DECISIONS, TIES, decisions, table

FLOOR, MARGIN, K, HASH_SHARE = 0.30, 0.02, 24, 0.2
# Scores are shown doubled: a mean of two six-digit scores has seven digits, its double six.
CUTOFFS = (0, 10, 20, 40)
#: The queries of a search; all rows are searched.
QUERIES_ARE = "vec_id % 50 = 0"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("string").alias("grp"), sign_bits(F.col("embedding")).alias("bits"))


def _short(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """Shortlist of every 50th row among all others.  Only ids, groups and hashes meet; vectors join after the cut."""
    v = _vectors(spark, sf_dir)
    q = v.where(QUERIES_ARE).selectExpr("vec_id q_id", "bits q_bits", "grp q_grp")
    d = v.selectExpr("vec_id d_id", "bits d_bits", "grp")
    return retrieval.shortlist(q, d, hamming_word(F.col("q_bits"), F.col("d_bits")), k, skip=F.col("q_id") == F.col("d_id"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    pairs = _short(spark, sf_dir).join(v.selectExpr("vec_id q_id", "embedding q_vec"), "q_id").join(v.selectExpr("vec_id d_id", "embedding d_vec"), "d_id")
    exact = F.round(cosine(F.col("q_vec"), F.col("d_vec")), 6)
    score = F.round((1 - HASH_SHARE) * exact + HASH_SHARE * (1 - F.col("distance") / 64), 6)
    return pairs.select("q_id", "q_grp", "grp", F.col("d_id").cast("string").alias("name"), score.alias("score"), "distance")


V = """v AS (
  SELECT vec_id, embedding, label::VARCHAR AS grp,
         list_sum([CASE WHEN embedding[i] > 0 THEN (1::HUGEINT << (i - 1)) ELSE 0 END FOR i IN range(1, 65)])::HUGEINT AS big FROM embeddings),
b AS (SELECT vec_id, embedding, grp, (CASE WHEN big >= 9223372036854775808::HUGEINT THEN big - 18446744073709551616::HUGEINT ELSE big END)::BIGINT AS bits FROM v),
p AS (
  SELECT q.vec_id AS q_id, q.grp AS q_grp, d.vec_id AS d_id, d.grp, bit_count(xor(q.bits, d.bits))::INT AS distance, q.embedding AS qe, d.embedding AS de
  FROM b q JOIN b d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, d_id) AS rank FROM p) WHERE rank <= 24)"""
SCORED = f"""{V},
c AS (
  SELECT q_id, q_grp, grp, d_id::VARCHAR AS name, distance,
         round(0.8::DOUBLE * round(list_cosine_similarity(qe::DOUBLE[], de::DOUBLE[]), 6) + 0.2::DOUBLE * (1 - distance / 64.0::DOUBLE), 6) AS score FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY q_id, grp ORDER BY score DESC, name DESC) AS n FROM c),
t AS (
  SELECT q_id, grp, avg(score) FILTER (n <= 2) AS score, max(name) FILTER (n = 1) AS name, max(score) AS best, count(*) AS votes
  FROM n GROUP BY q_id, grp),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, grp) AS rank FROM t),
g AS (
  SELECT q_id, max(grp) FILTER (rank = 1) AS grp, max(name) FILTER (rank = 1) AS name, max(score) FILTER (rank = 1) AS score,
         max(votes) FILTER (rank = 1) AS votes, max(score) FILTER (rank = 2) AS second FROM r GROUP BY q_id),
i AS (
  SELECT *, CASE WHEN score < 0.30 THEN 'below floor' WHEN second IS NOT NULL AND score - second < 0.02 THEN 'below margin' END AS rejected FROM g)"""


LEVELS = (0.0, 0.5, -0.5, 1.0)


def three_hashes(vectors: DataFrame) -> DataFrame:
    """Three 256-bit hashes of a vector of 64: elements against levels, against later elements, against the mean and levels."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size("embedding")
    word = lambda on: F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(on(i), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(b))
    hashes = {
        "phash": [word(lambda i, t=t: F.get("x", i) > t) for t in LEVELS],
        "dhash": [word(lambda i, k=k: F.get("x", (i + k + 1) % 64) > F.get("x", i)) for k in range(4)],
        "ahash": [word(lambda i, t=t: F.get("x", i) > F.col("mean") + t) for t in LEVELS],
    }
    return vectors.withColumn("x", x).withColumn("mean", mean).withColumns({k: F.array(*v) for k, v in hashes.items()}).drop("x", "mean")


def _cosines(vectors: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds the parts of a score to pairs: the vectors' cosine stands for the template, and no descriptor is there."""

    def score(pairs: DataFrame) -> DataFrame:
        both = pairs.join(vectors.selectExpr("vec_id q_id", "embedding q_vec"), "q_id").join(vectors.selectExpr("vec_id d_id", "embedding d_vec"), "d_id")
        return both.withColumn("template", F.round(cosine(F.col("q_vec"), F.col("d_vec")), 6)).withColumn("descriptor", F.lit(None).cast("double")).drop("q_vec", "d_vec")

    return score


def _bit_text(condition: str) -> str:
    return f"array_to_string([CASE WHEN {condition} THEN '1' ELSE '0' END FOR i IN range(256)], '')::BIT"


LEVEL = f"({list(LEVELS)}::DOUBLE[])[(i // 64) + 1]"
HASHED = f"""u AS (SELECT vec_id, label::VARCHAR AS grp, embedding, embedding::DOUBLE[] AS x, list_sum(embedding::DOUBLE[]) / 64 AS mean FROM embeddings),
h AS (
  SELECT vec_id, grp, embedding, {_bit_text(f"x[(i % 64) + 1] > {LEVEL}")} AS ph, {_bit_text("x[((i % 64 + i // 64 + 1) % 64) + 1] > x[(i % 64) + 1]")} AS dh,
    {_bit_text(f"x[(i % 64) + 1] > mean + {LEVEL}")} AS ah FROM u)"""


@query(f"""WITH {HASHED}, p AS (
  SELECT q.vec_id AS q_id, d.vec_id AS d_id, d.grp, d.vec_id::VARCHAR AS name, bit_count(xor(q.ph, d.ph)) AS bits, q.embedding AS qe, d.embedding AS de,
    1 - (0.55::DOUBLE * bit_count(xor(q.ph, d.ph)) / 256 + 0.30::DOUBLE * bit_count(xor(q.dh, d.dh)) / 256 + 0.15::DOUBLE * bit_count(xor(q.ah, d.ah)) / 256) / (0.55::DOUBLE + 0.30::DOUBLE + 0.15::DOUBLE) AS sim
  FROM h q JOIN h d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
s AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY sim DESC, d_id) AS place FROM p),
c AS (SELECT q_id, grp, name, round(0.8::DOUBLE * (0.75::DOUBLE * round(list_cosine_similarity(qe::DOUBLE[], de::DOUBLE[]), 6) / 0.75::DOUBLE) + 0.2::DOUBLE * sim, 6) AS score FROM s WHERE place <= 24),
n AS (SELECT *, row_number() OVER (PARTITION BY q_id, grp ORDER BY score DESC, name DESC) AS n FROM c),
t AS (SELECT q_id, grp, avg(score) FILTER (n <= 2) AS score, max(name) FILTER (n = 1) AS name, count(*) AS votes FROM n GROUP BY q_id, grp),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, grp) AS rank FROM t),
g AS (SELECT q_id, max(grp) FILTER (rank = 1) AS grp, max(name) FILTER (rank = 1) AS name, max(score) FILTER (rank = 1) AS score,
  max(votes) FILTER (rank = 1) AS votes, max(score) FILTER (rank = 2) AS second FROM r GROUP BY q_id)
SELECT g.q_id, g.grp, g.name, round(g.score * 2, 6) AS score_x2, g.votes,
  CASE WHEN g.score < 0.30 THEN 'below floor' WHEN second IS NOT NULL AND g.score - second < 0.02 THEN 'below margin' END AS rejected,
  s.name AS nearest_name, s.bits::INT AS nearest_bits, 'glyph' AS method FROM g JOIN s ON s.q_id = g.q_id AND s.place = 1""")
def full_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    # Few files make few tasks, and hashing and comparing are the work.
    h = three_hashes(v.repartition("vec_id")).select("vec_id", F.col("label").cast("string").alias("grp"), *retrieval.KINDS)
    q = h.where(QUERIES_ARE).selectExpr("vec_id q_id", "phash q_phash", "dhash q_dhash", "ahash q_ahash")
    d = h.selectExpr("vec_id d_id", "grp", "cast(vec_id as string) name", "phash", "dhash", "ahash")
    out = retrieval.lookup(q, d, _cosines(v), FLOOR, MARGIN, K, HASH_SHARE, skip=("q_id", "d_id"))
    return out.select("q_id", "grp", "name", F.round(F.col("score") * 2, 6).alias("score_x2"), "votes", "rejected", "nearest_name", "nearest_bits", "method")


RANKED = f"""{HASHED}, k AS (
  SELECT q.vec_id // 50 AS map, q.vec_id AS q_id, d.vec_id AS d_id, 'class ' || d.grp AS name, bit_count(xor(q.ph, d.ph))::INT AS bits,
    round(0.75::DOUBLE * round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) / 0.75::DOUBLE, 6) AS score
  FROM h q JOIN h d ON q.vec_id // 50 = d.vec_id // 50 AND q.vec_id % 7 <> 0 AND d.vec_id % 7 = 0),
r AS (
  SELECT *, row_number() OVER w AS rank, lead(score) OVER w AS second FROM k WINDOW w AS (PARTITION BY map, q_id ORDER BY score DESC, bits, d_id))"""


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    h = three_hashes(v).select("vec_id", F.expr("vec_id div 50").alias("map"), F.concat(F.lit("class "), "label").alias("name"), "phash")
    q = h.where("vec_id % 7 <> 0").selectExpr("map", "vec_id q_id", "phash q_phash")
    return retrieval.rank_legend(q, h.where("vec_id % 7 = 0").selectExpr("map", "vec_id d_id", "name", "phash"), "map", _cosines(v))


@query(f"WITH {RANKED} SELECT map, q_id, d_id, name, bits, score, rank FROM r")
def legend_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select("map", "q_id", "d_id", "name", "bits", "score", "rank")


@query(f"""WITH {RANKED}, x AS (
  SELECT map, q_id, name, CASE WHEN score < 0.1 THEN 'below floor' WHEN second IS NOT NULL AND score - second < 0.05::DOUBLE THEN 'below margin' END AS rejected FROM r WHERE rank = 1)
SELECT map, q_id, rejected, CASE WHEN rejected IS NULL THEN name END AS class_name FROM x""")
def raw_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.sorted_in(_ranked(spark, sf_dir), 0.1, 0.05).select("map", "q_id", "rejected", "class_name")


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.decide(retrieval.vote(_scored(spark, sf_dir)), FLOOR, MARGIN)


@query(f"WITH {SCORED} SELECT q_id, grp, name, round(score * 2, 6) AS score_x2, votes, round((score - coalesce(second, 0)) * 2, 6) AS gap_x2, rejected FROM i")
def identify_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _identified(spark, sf_dir)
    return out.select("q_id", "grp", "name", F.round(F.col("score") * 2, 6).alias("score_x2"), "votes", F.round(F.col("gap") * 2, 6).alias("gap_x2"), "rejected")


@query(f"WITH {V} SELECT q_id, d_id, distance, rank FROM s")
def hamming_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short(spark, sf_dir).select("q_id", "d_id", "distance", "rank")


@query(f"WITH {SCORED} SELECT q_id, grp, name, round(score * 2, 6) AS score_x2, best, votes, rank FROM r WHERE rank <= 5")
def group_vote_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.vote(_scored(spark, sf_dir)).where("rank <= 5")
    return rows.select("q_id", "grp", "name", F.round(F.col("score") * 2, 6).alias("score_x2"), "best", "votes", "rank")


@query(f"""WITH {SCORED}, x AS (
  SELECT 'hamming<=' || k.k AS strategy, s.distance <= k.k AS hit, s.grp = s.q_grp AS correct
  FROM (SELECT * FROM s WHERE rank = 1) s, (SELECT unnest([0, 10, 20, 40]) AS k) k
  UNION ALL SELECT 'vote', i.rejected IS NULL, i.grp = q.grp FROM i JOIN b q ON i.q_id = q.vec_id)
SELECT strategy, count(*) AS n, round(avg(hit::INT), 6) AS coverage,
       round(CASE WHEN count_if(hit) > 0 THEN count_if(hit AND correct) / count_if(hit)::DOUBLE ELSE 0 END, 6) AS accuracy,
       round(count_if(hit AND correct) / count(*)::DOUBLE, 6) AS yield
FROM x GROUP BY strategy""")
def bench_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = retrieval.nearest(_short(spark, sf_dir))
    parts = [near.select(F.lit(f"hamming<={c}").alias("strategy"), (F.col("distance") <= c).alias("hit"), (F.col("grp") == F.col("q_grp")).alias("correct")) for c in CUTOFFS]
    truth = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("q_id"), F.col("label").cast("string").alias("truth"))
    got = _identified(spark, sf_dir).join(truth, "q_id")
    parts.append(got.select(F.lit("vote").alias("strategy"), F.col("rejected").isNull().alias("hit"), (F.col("grp") == F.col("truth")).alias("correct")))
    out = retrieval.rates(reduce(DataFrame.unionByName, parts))
    return out.select("strategy", "n", *[F.round(c, 6).alias(c) for c in ("coverage", "accuracy", "yield")])


@query(f"WITH {V} SELECT q_id, d_id, distance FROM p WHERE distance <= 18")
def hamming_radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    pairs = retrieval.hash_join(v.where(QUERIES_ARE).selectExpr("vec_id q_id", "bits q_bits"), v.selectExpr("vec_id d_id", "bits d_bits"), 18)
    return pairs.where("q_id <> d_id").select("q_id", "d_id", "distance")


@query(f"""WITH {V}, c AS (SELECT q_id, grp, d_id::VARCHAR AS name, distance, 1 - distance / 64.0::DOUBLE AS score, rank FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY q_id, grp ORDER BY score DESC, name DESC) AS n FROM c),
t AS (SELECT q_id, grp, avg(score) FILTER (n <= 2) AS score, max(name) FILTER (n = 1) AS name, count(*) AS votes FROM n GROUP BY q_id, grp),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, grp) AS rank FROM t),
g AS (
  SELECT q_id, max(grp) FILTER (rank = 1) AS grp, max(name) FILTER (rank = 1) AS name, max(score) FILTER (rank = 1) AS score,
         max(votes) FILTER (rank = 1) AS votes, max(score) FILTER (rank = 2) AS second FROM r GROUP BY q_id)
SELECT g.q_id, CASE WHEN c.distance <= 18 THEN c.grp ELSE g.grp END AS grp, CASE WHEN c.distance <= 18 THEN c.name ELSE g.name END AS name,
  round(CASE WHEN c.distance <= 18 THEN c.score ELSE g.score END, 6) AS score, CASE WHEN c.distance <= 18 THEN 1 ELSE g.votes END AS votes,
  CASE WHEN c.distance <= 18 THEN NULL WHEN g.score < 0.65 THEN 'below floor' WHEN second IS NOT NULL AND g.score - second < 0.01 THEN 'below margin' END AS rejected,
  c.distance AS nearest_bits
FROM g JOIN c ON c.q_id = g.q_id AND c.rank = 1""")
def match_by_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = _short(spark, sf_dir).select("q_id", "grp", F.col("d_id").cast("string").alias("name"), (1 - F.col("distance") / 64).alias("score"), F.col("distance").alias("bits"), "rank")
    out = retrieval.match_hashes(short.where("rank = 1"), short, shortcut=18, floor=0.65, margin=0.01)
    return out.withColumn("score", F.round("score", 6))




@query("""WITH h AS (SELECT doc_id, md5(text) || md5(source) AS hex FROM documents),
n AS (SELECT a.doc_id, a.hex AS x, b.hex AS y FROM h a JOIN h b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, list_sum([bit_count(xor(('0x' || substr(x, k * 8 + 1, 8))::BIGINT, ('0x' || substr(y, k * 8 + 1, 8))::BIGINT)) FOR k IN range(8)])::INT AS bits,
       round(1 - list_sum([bit_count(xor(('0x' || substr(x, k * 8 + 1, 8))::BIGINT, ('0x' || substr(y, k * 8 + 1, 8))::BIGINT)) FOR k IN range(8)]) / 256.0::DOUBLE, 6) AS similarity
FROM n""")
def hex_hash_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "documents").select("doc_id", hex_words(F.concat(F.md5("text"), F.md5("source")), 4).alias("a"))
    pairs = h.join(h.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b")), "doc_id")
    bits = hamming(F.col("a"), F.col("b"))
    missing = F.lit(None).cast("int")
    return pairs.select("doc_id", bits.alias("bits"), F.round(weighted_similarity({"phash": bits, "dhash": missing}, 256), 6).alias("similarity"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  round(CASE WHEN l_partkey % 5 = 0 AND l_suppkey % 7 = 0 THEN 0 WHEN l_partkey % 5 = 0 THEN 0.25 * l_tax / 0.25
             WHEN l_suppkey % 7 = 0 THEN 0.75 * l_discount / 0.75 ELSE 0.75 * l_discount + 0.25 * l_tax END, 6) AS score
FROM lineitem""")
def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.when(F.col("l_partkey") % 5 != 0, F.col("l_discount"))
    b = F.when(F.col("l_suppkey") % 7 != 0, F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.round(combined([(0.75, a), (0.25, b)]), 6).alias("score"))


@query("""WITH x AS (
  SELECT o_custkey AS key, o_orderkey AS ord, round(o_totalprice / 1000000, 6) AS score, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 50)::INT END AS bits FROM orders),
r AS (
  SELECT *, row_number() OVER w AS rank, coalesce(lead(score) OVER w, 0) AS second FROM x
  WINDOW w AS (PARTITION BY key ORDER BY score DESC, coalesce(bits, 1000000000), ord))
SELECT key, ord, score, second, round(score - second, 6) AS margin FROM r WHERE rank = 1""")
def rank_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "orders").selectExpr("o_custkey key", "o_orderkey ord", "round(o_totalprice / 1000000, 6) score", "case when o_orderkey % 3 > 0 then cast(o_orderkey % 50 as int) end bits")
    return retrieval.rank_rows(x, ["key"], "ord").where("rank = 1").select("key", "ord", "score", "second", F.round("margin", 6).alias("margin"))


@query("""WITH x AS (SELECT o_custkey AS key, o_orderkey AS rank, o_orderpriority AS name,
  CASE o_orderkey % 5 WHEN 0 THEN 'same' WHEN 1 THEN 'related' END AS relation FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE relation WHEN 'same' THEN 0 ELSE 1 END, rank) AS n FROM x WHERE relation IS NOT NULL)
SELECT key, rank, name, relation FROM r WHERE n = 1""")
def semantic_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "orders").selectExpr("o_custkey key", "o_orderkey rank", "o_orderpriority name", "case o_orderkey % 5 when 0 then 'same' when 1 then 'related' end relation")
    return decide.semantic_row(x, ["key"])


def _cascade(naming: str, columns: str = ", ".join(TIES)) -> str:
    pick = {"legend": "coalesce({l}, {k})", "db": "coalesce({k}, {l})"}[naming]
    lab = lambda l, k: pick.format(l=f"nullif(trim({l}), '')", k=f"nullif(trim({k}), '')")  # noqa: E731, E741
    return f"""WITH {DECISIONS},
a AS (
  SELECT *, CASE WHEN n_legend > 0 THEN score ELSE -1 END AS ls,
    CASE WHEN n_legend > 0 THEN score ELSE -1 END - CASE WHEN n_legend > 1 THEN second ELSE 0 END AS lm FROM d),
b AS (SELECT *, n_legend > 0 AND ls >= 0.60 AS passes_floor, n_legend < 2 OR lm >= 0.08 AS passes_margin FROM a),
c AS (
  SELECT *, CASE WHEN found_relation = 'related' THEN CASE WHEN sem_rank <> 1 THEN 'not the best' WHEN NOT passes_floor THEN 'below floor'
    WHEN NOT passes_margin THEN 'below margin' END END AS relation_rejected FROM b),
e AS (SELECT *, CASE WHEN relation_rejected IS NULL THEN found_relation END AS relation, passes_floor AND passes_margin AS wins FROM c),
f AS (
  SELECT *, db_class IS NULL AND coalesce(relation = 'same', false) AND NOT wins AND coalesce(sem_score >= 0.35 AND nearest_bits <= 40, false) AS rescued,
    coalesce(relation = 'same', false) AND coalesce(sem_name = legend_name, false) AS agrees FROM e)
SELECT {columns}, relation, relation_rejected, rescued,
  CASE WHEN db_class IS NOT NULL AND relation IS NOT NULL THEN {lab("sem_name", "db_class")} WHEN db_class IS NOT NULL THEN db_class
    WHEN wins AND agrees THEN {lab("legend_name", "nearest_name")} WHEN wins THEN legend_name
    WHEN rescued THEN {lab("sem_name", "nearest_name")} ELSE original_class END AS final_class,
  CASE WHEN db_class IS NOT NULL AND relation IS NOT NULL THEN 'phash_db+' || relation WHEN db_class IS NOT NULL THEN 'phash_db'
    WHEN wins AND agrees THEN 'legend+synonym' WHEN wins THEN 'legend' WHEN rescued THEN 'synonym_agree' END AS match_method
FROM f"""


#: The cascade with what a report of its stages shows.
CASCADE_STAGES = _cascade("legend", ", ".join([*TIES, "db_class", "nearest_name", "nearest_bits", "legend_name", "ls", "lm", "sem_name"]))
OUT = [*TIES, "relation", "relation_rejected", "rescued", "final_class", "match_method"]


@query(_cascade("legend"))
def decision_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.decide_class(decisions(spark, sf_dir)).select(*OUT)


@query(_cascade("db"))
def decision_cascade_db_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.decide_class(decisions(spark, sf_dir), decide.Gates(naming="db")).select(*OUT)


@query(f"WITH x AS ({_cascade('legend')}) SELECT coalesce(match_method, 'kept') AS method, count(*) AS n, count(DISTINCT final_class) AS classes FROM x GROUP BY ALL")
def decision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decide.decide_class(decisions(spark, sf_dir))
    return out.groupBy(F.coalesce("match_method", F.lit("kept")).alias("method")).agg(F.count("*").alias("n"), F.count_distinct("final_class").alias("classes"))
