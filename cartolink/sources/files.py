"""Files, folders, saved detector responses, hash tables and taxonomies as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolink.functions.bits import hex_words
from cartolink.functions.geometry import centre_box
from cartolink.functions.text import IMAGE_TYPES

RESPONSE = T.StructType([
    T.StructField("predictions", T.ArrayType(T.StructType([
        *[T.StructField(c, T.DoubleType()) for c in ("x", "y", "width", "height", "confidence")],
        T.StructField("class", T.StringType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("points", T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))),
    ]))),
])


def images(spark: SparkSession, root: str, deep: bool = False, content: bool = False) -> DataFrame:
    """(path, length, modificationTime[, content]) of the image files in a folder, or below it."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", str(deep).lower())
    files = read.load(root).where(F.lower("path").rlike(IMAGE_TYPES))
    return files if content else files.drop("content")


def relative(files: DataFrame, root: str) -> DataFrame:
    """``rel``: the path below ``root``; ``class``: its first folder, null for files in the root itself."""
    at = F.instr(F.col("path"), root.rstrip("/") + "/")
    rel = F.substring(F.col("path"), at + len(root.rstrip("/")) + 1, F.length("path"))
    return files.withColumn("rel", rel).withColumn("class", F.when(F.contains("rel", F.lit("/")), F.split("rel", "/")[0]))


def class_folders(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Files one folder below the root, with that folder as their class."""
    return relative(images(spark, root, deep=True, content=content), root).where(F.size(F.split("rel", "/")) == 2)


def detections(spark: SparkSession, path: str) -> DataFrame:
    """Saved detector responses (a JSON object or a list of one) to boxes.

    Columns image_id (the file), det_id, class_name, confidence, x1..y2, polygon.
    Predictions without a centre or size are dropped.
    """
    raw = spark.read.option("multiLine", "true").schema(RESPONSE).json(path).withColumn("image_id", F.input_file_name())
    return parse_predictions(raw)


def parse_predictions(raw: DataFrame) -> DataFrame:
    rows = raw.select("image_id", F.posexplode("predictions").alias("det_id", "p"))
    rows = rows.where("p.x is not null and p.y is not null and p.width is not null and p.height is not null")
    box = centre_box(F.col("p.x"), F.col("p.y"), F.col("p.width"), F.col("p.height"))
    return rows.select(
        "image_id",
        "det_id",
        F.coalesce("p.class", "p.class_name", F.lit("icon")).alias("class_name"),
        F.coalesce("p.confidence", F.lit(0.0)).alias("confidence"),
        *[c.alias(n) for c, n in zip(box, ("x1", "y1", "x2", "y2"), strict=True)],
        F.col("p.points").alias("polygon"),
    )


def flat_hashes(spark: SparkSession, path: str, words: int = 4) -> DataFrame:
    """A JSON object of hexadecimal hash to class -> (hash, class_name, bits); bad hashes are dropped."""
    text = spark.read.option("wholetext", "true").text(path)
    pairs = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("hash", "class_name"))
    return pairs.withColumn("bits", hex_words(F.col("hash"), words)).where("bits is not null")


def nested_hashes(spark: SparkSession, path: str, words: int = 4) -> DataFrame:
    """A JSON object of class to file to hash -> (class_name, file, hash, bits)."""
    text = spark.read.option("wholetext", "true").text(path)
    one = text.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("class_name", "files"))
    return one.select("class_name", F.explode("files").alias("file", "hash")).withColumn("bits", hex_words(F.col("hash"), words))


def exemplars(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exemplar table; columns that it lacks are null, and no table is an empty one."""
    empty = spark.createDataFrame([], schema)
    try:
        found = spark.read.parquet(path)
    except Exception as error:  # a missing store disables the lookup, as a missing file does
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return empty
    return empty.unionByName(found.select(*[c for c in found.columns if c in schema.names]), allowMissingColumns=True)


def taxonomy(spark: SparkSession, groups_path: str, related_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JSON objects of group to terms and of group to neighbours -> groups, terms, edges.

    Order is that of the file.  Neighbours of unknown groups are dropped.
    """
    read = lambda p: spark.read.option("wholetext", "true").text(p)
    lists = "map<string,array<string>>"
    flat = read(groups_path).select(F.posexplode(F.from_json("value", lists)).alias("ord", "canonical", "terms"))
    groups = flat.select("canonical", "ord")
    terms = flat.select("canonical", "ord", F.posexplode("terms").alias("pos", "term"))
    if related_path is None:
        return groups, terms, spark.createDataFrame([], "src string, dst string")
    edges = read(related_path).select(F.explode(F.from_json("value", lists)).alias("src", "all")).select("src", F.explode("all").alias("dst"))
    return groups, terms, edges.join(groups.select(F.col("canonical").alias("src")), "src", "left_semi")


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """(name): a text file's lines without blanks at their ends and without blank lines."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def collect_names(one: DataFrame, two: DataFrame) -> DataFrame:
    """(name) of either, trimmed, once each, sorted without regard to case."""
    both = one.select(F.trim("name").alias("name")).unionByName(two.select(F.trim("name").alias("name")))
    return both.where("name <> ''").distinct().orderBy(F.lower("name"), "name")


def reported_angle(report: DataFrame, least: float = 0.5) -> DataFrame:
    """(image_id, report) of an orientation probe -> image_id, angle; null if not sure or no right angle."""
    angle = F.pmod(F.regexp_extract("report", r"Rotate:\s*(\d+)", 1).try_cast("int"), F.lit(360))
    sure = F.coalesce(F.regexp_extract("report", r"Orientation confidence:\s*([0-9.]+)", 1).try_cast("double"), F.lit(0.0))
    return report.select("image_id", F.when((sure >= least) & angle.isin(0, 90, 180, 270), angle).alias("angle"))
