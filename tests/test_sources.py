import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolink.functions import images
from cartolink.operators import decide, retrieval
from cartolink.plans import QUERIES
from cartolink.sources import files, sinks
from cartolink.streaming.watch import process_new


@pytest.fixture
def tree(tmp_path):
    for name in ("Parking/a.png", "Parking/b.JPG", "Trail/c.tiff", "Trail/notes.txt", "top.bmp", "Trail/deep/d.webp"):
        path = tmp_path / "icons" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    return str(tmp_path / "icons")


def test_folders(spark, tree):
    assert files.images(spark, tree).count() == 1 and files.images(spark, tree, deep=True).count() == 5
    rel = files.relative(files.images(spark, tree, deep=True), tree)
    assert {(r["rel"], r["class"]) for r in rel.collect()} >= {("top.bmp", None), ("Trail/deep/d.webp", "Trail")}
    assert {r["rel"] for r in files.class_folders(spark, tree).collect()} == {"Parking/a.png", "Parking/b.JPG", "Trail/c.tiff"}


def test_detector_responses(spark, tmp_path):
    good = {"x": 10.5, "y": 20, "width": 5, "height": 4, "confidence": 0.5, "class_name": "Trail", "points": [{"x": 1, "y": 2}]}
    (tmp_path / "one.json").write_text(json.dumps({"predictions": [good, {"x": 1}, {"x": 5, "y": 5, "width": 2, "height": 2}]}))
    (tmp_path / "two.json").write_text(json.dumps([{"predictions": [good | {"class": "Park"}]}]))
    rows = files.detections(spark, str(tmp_path)).orderBy("image_id", "det_id").collect()
    assert [(r["class_name"], r["x1"], r["y1"], r["x2"], r["y2"], r["confidence"]) for r in rows] == [("Trail", 8, 18, 13, 22, 0.5), ("icon", 4, 4, 6, 6, 0.0), ("Park", 8, 18, 13, 22, 0.5)]


def test_hashes_and_taxonomy(spark, tmp_path):
    (tmp_path / "flat.json").write_text(json.dumps({"f" * 64: "Trail", "bad": "x"}))
    assert [(r["class_name"], r["bits"]) for r in files.flat_hashes(spark, str(tmp_path / "flat.json")).collect()] == [("Trail", [-1] * 4)]
    (tmp_path / "nested.json").write_text(json.dumps({"Trail": {"a.png": "0" * 64}}))
    assert files.nested_hashes(spark, str(tmp_path / "nested.json")).first()["bits"] == [0] * 4
    (tmp_path / "groups.json").write_text(json.dumps({"b": ["x", "y"], "a": []}))
    (tmp_path / "near.json").write_text(json.dumps({"b": ["a"], "zz": ["b"]}))
    groups, terms, edges = files.taxonomy(spark, str(tmp_path / "groups.json"), str(tmp_path / "near.json"))
    assert [r["canonical"] for r in groups.orderBy("ord").collect()] == ["b", "a"]
    assert [tuple(r) for r in edges.collect()] == [("b", "a")] and terms.count() == 2
    (tmp_path / "names.txt").write_text(" Trail \n\nPark\n")
    assert {r[0] for r in files.name_list(spark, str(tmp_path / "names.txt")).collect()} == {"Trail", "Park"}


def test_exemplar_store(spark, tmp_path):
    schema = T.StructType([T.StructField("exemplar_id", T.LongType()), T.StructField("class_name", T.StringType()), T.StructField("phash", T.ArrayType(T.LongType()))])
    path = str(tmp_path / "db")
    assert files.exemplars(spark, path, schema).count() == 0
    sinks.write_exemplars(spark.createDataFrame([(1, "Trail")], "exemplar_id long, class_name string"), path)
    assert files.exemplars(spark, path, schema).first()["phash"] is None


def test_sinks(spark, tmp_path):
    rows = decide.decide_class(spark.createDataFrame(
        [("k", "icon", "db", "db", 0, 0, None, None, None, None, None, None, None)],
        "key string, original_class string, db_class string, nearest_name string, nearest_bits int, n_legend int, legend_name string, score double, second double, sem_name string, sem_score double, sem_rank int, found_relation string",
    ))
    report = sinks.report_lines(rows)
    assert report.first()["report"].split("\n")[-1] == "FINAL: db by phash_db"
    sinks.write_reports(report.withColumnRenamed("key", "name"), str(tmp_path / "reports"))
    assert "FINAL" in "".join(p.read_text() for p in (tmp_path / "reports").rglob("*.txt"))
    sinks.write_json(spark.range(2), str(tmp_path / "json"), one_file=True)
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    sinks.write_hashes(spark.createDataFrame([("c", "f", "0")], "class_name string, file string, hash string"), str(tmp_path / "hashes"))
    assert spark.read.json(str(tmp_path / "hashes")).first()["files"]["f"] == "0"


def test_stream_sees_each_file_once(spark, tree, tmp_path):
    run = lambda: process_new(spark, tree, lambda b: b.select("path", "length"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (tmp_path / "icons" / "new.png").write_bytes(b"x")
    run()
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["new.png", "top.bmp"]


def resized_noise(rng):
    """A picture with structure: coarse noise, made larger."""
    return np.rint(images.resize(rng.integers(0, 255, (16, 16)), 64, 64)).astype(np.uint8)


def test_pixels():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 255, (60, 40, 3)).astype(np.uint8)
    masked = images.mask_icons(image, [(5, 5, 30, 30)], protect=[(20, 10, 35, 20)])
    assert (masked[10:20, 20:35] == image[10:20, 20:35]).all() and (masked[8, 8] != image[8, 8]).any() and (masked[40:] == image[40:]).all()
    crop = np.full((50, 50), 200, np.uint8)
    crop[15:35, 20:30] = 20
    glyph = images.glyph(crop)
    assert glyph.shape == (64, 64) and glyph[32, 32] == 20 and glyph[32, 2] == images.GREY
    assert images.correlation(glyph, glyph) == pytest.approx(1.0) and images.correlation(glyph, 255 - glyph) < 0.9
    wave = resized_noise(rng)
    same = images.perceptual_hash(wave)
    for kind in ("phash", "dhash", "ahash", "whash"):
        off = lambda other: (images.perceptual_hash(wave, kind) != images.perceptual_hash(other, kind)).sum()  # noqa: E731, B023
        assert off(images.degrade(wave, 3, noise=2.0)) < off(resized_noise(rng)) / 2
    assert (images.rotate(images.rotate(image, 90), 270) == image).all()
    with pytest.raises(ValueError):
        images.rotate(image, 45)
    assert len(images.words_of(same)) == 4


def test_pixel_columns(spark):
    glyph = images.glyph(np.pad(np.zeros((10, 20), np.uint8), 10, constant_values=255)).tobytes()
    df = spark.createDataFrame([(bytearray(glyph),), (None,)], "g binary")
    got = df.select(images.glyph_hashes("g").alias("h"), images.glyph_score("g", "g").alias("s")).collect()
    assert len(got[0]["h"]["phash"]) == 4 and got[0]["s"] == pytest.approx(1.0) and got[1]["s"] is None


def test_glyph_scores_by_sums_over_places():
    rng = np.random.default_rng(3)
    a, b = resized_noise(rng), images.degrade(resized_noise(rng), 1)
    field, best = np.pad(a.astype(float), images.PAD, constant_values=images.GREY), 0.0
    for side in (51, 58, 64, 70):  # 80 is more than the padded 76
        t = np.rint(images.resize(b, side, side))
        for y in range(77 - side):
            for x in range(77 - side):
                part = field[y : y + side, x : x + side]
                best = max(best, float(np.corrcoef(part.ravel(), t.ravel())[0, 1]))
    assert images.correlation(a, b) == pytest.approx(best, abs=1e-9)
    assert images.correlation(a, np.full((64, 64), 9, np.uint8)) == 0.0


def test_glyph_parts():
    rng = np.random.default_rng(4)
    mask = rng.random((9, 7)) > 0.4
    near = lambda y, x: [mask[j, i] if 0 <= j < 9 and 0 <= i < 7 else True for j in range(y - 1, y + 2) for i in range(x - 1, x + 2)]
    assert (images.box_counts(mask, True) == [[sum(near(y, x)) for x in range(7)] for y in range(9)]).all()
    grey = rng.integers(0, 255, (30, 50)).astype(np.uint8)
    canvas = np.full((50, 50), images.GREY)
    canvas[10:40] = grey
    assert (images.squared(grey) == np.rint(images.resize(canvas, 64, 64))).all()


def test_image_columns(spark):
    rng = np.random.default_rng(5)
    image = rng.integers(0, 255, (8, 6, 3)).astype(np.uint8)
    rows = [((8, 6, 3, bytearray(image.tobytes())), 90, [(1, 1, 5, 5)], [(2, 2, 3, 3)]), ((8, 6, 3, bytearray(b"short")), 90, None, None), (None, 45, [], []), ((8, 6, 3, bytearray(image.tobytes())), 30, None, None)]
    box = "array<struct<x1:int,y1:int,x2:int,y2:int>>"
    df = spark.createDataFrame(rows, f"image struct<height:int,width:int,channels:int,pixels:binary>, angle int, icons {box}, keep {box}")
    got = df.select(images.rotated("image", "angle").alias("r"), images.masked("image", "icons", "keep").alias("m"), images.glyph_of("image").alias("g"), images.degraded(images.glyph_of("image"), F.lit(1)).alias("d")).collect()
    assert bytes(got[0]["r"]["pixels"]) == images.rotate(image, 90).tobytes() and got[0]["r"]["height"] == 6
    assert bytes(got[0]["m"]["pixels"]) == images.mask_icons(image, [(1, 1, 5, 5)], [(2, 2, 3, 3)]).tobytes()
    assert bytes(got[0]["g"]) == images.glyph(image).tobytes() and len(got[0]["d"]) == 4096
    assert got[1]["g"] is None and got[2]["g"] is None and got[3]["r"]["pixels"] is None and got[3]["m"]["pixels"] is not None


def test_plans(spark, tmp_path):
    vec = [(k, [float((k * 7 + i * 3) % 11 - 5) for i in range(64)], k % 3) for k in range(40)]
    spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    plan = QUERIES["hamming_shortlist"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "BroadcastNestedLoopJoin" in plan and "Python" not in plan
    spark.range(10).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(3).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    read = QUERIES["left_to_do"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "LeftAnti" in read and "ReadSchema: struct<doc_id:bigint,source:string>" in read


def test_glyph_lookup_finds_worse_copies(spark):
    rng = np.random.default_rng(6)
    pictures = [resized_noise(rng) for _ in range(12)]
    exemplars = spark.createDataFrame([(k, f"g{k}", f"n{k}", bytearray(p.tobytes())) for k, p in enumerate(pictures)], "d_id long, grp string, name string, glyph binary")
    queries = spark.createDataFrame([(k, bytearray(images.degrade(pictures[k], k, 3.0).tobytes())) for k in (2, 7, 9)], "q_id long, q_glyph binary")
    hashes = lambda df, col, prefix: df.withColumn("h", images.glyph_hashes(col)).select("*", *[F.col(f"h.{c}").alias(f"{prefix}{c}") for c in retrieval.KINDS]).drop("h")

    def score(pairs):
        both = pairs.join(queries, "q_id").join(exemplars.select("d_id", "glyph"), "d_id")
        return both.withColumn("template", images.glyph_score("q_glyph", "glyph")).withColumn("descriptor", F.lit(None).cast("double"))

    got = retrieval.lookup(hashes(queries, "q_glyph", "q_").drop("q_glyph"), hashes(exemplars, "glyph", "").drop("glyph"), score, 0.6, 0.06, k=5).collect()
    assert {(r["q_id"], r["grp"], r["nearest_name"], r["rejected"]) for r in got} == {(k, f"g{k}", f"n{k}", None) for k in (2, 7, 9)}


def test_taxonomy_files(spark, tmp_path):
    tables = {name: spark.createDataFrame([(name,)], "key string") for name in sinks.TAXONOMY}
    sinks.write_taxonomy(tables, str(tmp_path / "tax"))
    assert spark.read.json(f"{tmp_path}/tax/search_index").first()["key"] == "search_index"
    with pytest.raises(ValueError):
        sinks.write_taxonomy({}, str(tmp_path / "none"))
