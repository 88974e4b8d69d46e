import difflib
import random

import pytest
from pyspark.sql import functions as F

from cartolink.functions import bits, geometry as geo, text as tx
from cartolink.operators import curation, taxonomy as tax

GROUPS = {
    "observation area": ["overlook", "scenic vista", "scenic view", "viewpoint"],
    "contact station": ["ranger contact"],
    "hike and bike campground": ["campground hike & bike"],
    "hiking": ["hiking trail", "trail"],
    "biking": ["bicycling", "bike"],
    "motorbike trail": ["motor bike trail"],
    "mountain summit": ["summit"],
    "restroom": ["restrooms", "toilet"],
    "parking": ["parking area"],
}
RELATED = [("biking", "motorbike trail"), ("observation area", "mountain summit"), ("hiking", "hiking"), ("biking", "nowhere")]


@pytest.fixture(scope="module")
def taxonomy(spark):
    groups = spark.createDataFrame([(c, k) for k, c in enumerate(GROUPS)], "canonical string, ord int")
    terms = spark.createDataFrame([(c, k, p, t) for k, (c, ts) in enumerate(GROUPS.items()) for p, t in enumerate(ts)], "canonical string, ord int, pos int, term string")
    edges = tax.symmetric(spark.createDataFrame(RELATED, "src string, dst string"), groups.select(F.col("canonical").alias("node")))
    return groups, terms, edges


def apply(spark, f, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(f(F.col("v")).alias("r")).collect()]


@pytest.mark.parametrize(
    "f, given, expected",
    [
        (tx.name_key, ["Contact_Station", "Campground Hike & Bike", "Overlook. ", " -a:-", None, "8% x"], ["contact station", "campground hike and bike", "overlook", "a", "", "8 x"]),
        (tx.term_key, ["Contact_Station", "a:b", "Slope 8%", "Scenic  Vista"], ["contact station", "a : b", "slope 8%", "scenic vista"]),
        (tx.singular, ["cabins", "beaches", "berries", "glass", "as", "axes", "class"], ["cabin", "beach", "berry", "glass", "as", "axe", "class"]),
        (tx.digit_fold, ["0verl00k 5"], ["overlook s"]),
        (tx.clean_token, ["  |Picnic   Area_ ", "..."], ["Picnic Area", ""]),
        (tx.safe_name, ["a/b c", "  ", "é(1).png"], ["a_b_c", "unnamed", "é(1).png"]),
        (tx.path_key, ["x/My Map-1.final.PNG", ".hidden"], ["mymap1final", "hidden"]),
        (tx.source_name, ["MAP_1 (2).png", "MAP_jpg_12.png", "_1.png"], ["MAP", "MAP_jpg", "_1"]),
        (tx.clean_export_name, ["my map_jpg.rf.09aF.png", "my map.png", "none"], ["my_map.png", "my_map.png", "none"]),
        (tx.initial_bucket, ["1 apple", "Parking", "zoo", "éa", "12"], ["A-H", "I-P", "Q-Z", "Other", "Other"]),
        (lambda c: tx.tree_key(c, "name", True), ["A\\b\\C.PNG", "x/.rc"], ["c", ".rc"]),
    ],
)
def test_scalars(spark, f, given, expected):
    assert apply(spark, f, given) == expected


def test_truncation(spark):
    rows = [("arking Area", "Parking Area"), ("Area", "Parking Area"), ("Scenic", "Scenic View"), ("Area", "Area"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(tx.is_truncation(F.col("a"), F.col("b"))).collect()] == [True, True, False, False, False]


def test_ladder(spark, taxonomy):
    groups, terms, _ = taxonomy
    cases = {
        "Overlook": "observation area", "Scenic  Vista": "observation area", "0verlook": "observation area", "Contact_Station": "contact station",
        "Campground Hike & Bike": "hike and bike campground", "Overlook Trail": None, "Restrooms": "restroom", "Scenic Overlook Place": "observation area",
        "Viewpont": "observation area", "zzz": None, "": None,
    }
    names = spark.createDataFrame([(n,) for n in cases], "name string")
    assert dict(map(tuple, tax.canonical_names(names, groups, terms).collect())) == cases
    assert dict(map(tuple, tax.canonical_names(names, groups, terms, cutoff=1.0).collect()))["Viewpont"] is None


def test_relation(spark, taxonomy):
    edges = taxonomy[2]
    rows = [("Bicycling", "Motor Bike Trail", "biking", "motorbike trail", "related"), ("Bicycling", "Biking", "biking", "biking", "same"),
            ("Bicycling", "Restrooms", "biking", "restroom", None), ("X_y", "x y", None, None, "same"), ("x", "y", None, "biking", None)]
    df = spark.createDataFrame([r[:4] for r in rows], "a string, b string, ca string, cb string")
    got = {(r["a"], r["b"]): r["relation"] for r in tax.relation(df, edges).collect()}
    assert got == {r[:2]: r[4] for r in rows}


def test_graph_is_symmetric(taxonomy):
    edges = set(map(tuple, taxonomy[2].select("src", "dst").collect()))
    assert edges == {("biking", "motorbike trail"), ("motorbike trail", "biking"), ("observation area", "mountain summit"), ("mountain summit", "observation area")}


def test_builder(spark, taxonomy):
    groups, terms, edges = taxonomy
    classes = spark.createDataFrame([("Overlook",), ("OVERLOOK",), ("Bike",), ("Nothing",)], "class_name string")
    mapped = tax.classify(classes, tax.term_index(groups, terms))
    assert dict(map(tuple, mapped.collect())) == {"Overlook": "observation area", "OVERLOOK": "observation area", "Bike": "biking", "Nothing": None}
    merged = tax.merged_terms(groups, mapped, terms)
    own = [r["term"] for r in merged.where("canonical = 'observation area'").orderBy("place").collect()]
    assert own == ["observation area", "overlook", "scenic vista", "scenic view", "viewpoint"]
    near = {r["key"]: r for r in tax.neighbours(mapped, merged, edges).collect()}
    assert near["overlook"]["classes"] == ["OVERLOOK", "Overlook"] and near["bike"]["related"] == ["motorbike trail"]
    hits = [(r["canonical"], r["term"], r["exact"]) for r in tax.search(merged, "Trail").collect()]
    assert hits == [("hiking", "trail", True), ("motorbike trail", "motorbike trail", False)] or hits[0][0] == "hiking"


def test_bits(spark):
    df = spark.createDataFrame([("f" * 16 + "0" * 16, "0" * 32), ("zz", "0" * 32)], "a string, b string")
    got = df.select(bits.hamming(bits.hex_words(F.col("a"), 2), bits.hex_words(F.col("b"), 2)).alias("d")).collect()
    assert [r["d"] for r in got] == [64, None]


def test_half_even(spark):
    df = spark.createDataFrame([(2.5, 1.0, 4.0, 2.0)], "x double, y double, w double, h double")
    row = df.select(*[c.alias(n) for n, c in geo.centre_box(F.col("x"), F.col("y"), F.col("w") + 1, F.col("h"))._asdict().items()]).first()
    assert tuple(row) == (0, 0, 5, 2)


def test_plans(spark):
    plan = spark.createDataFrame([("a", "d/x.png"), ("b", "d/x.png"), ("c", "d.v/x")], "src string, dest string")
    taken = spark.createDataFrame([("d.v/x",)], "path string")
    got = {r["src"]: r["final"] for r in curation.destinations(plan, taken=taken).collect()}
    assert got == {"a": "d/x.png", "b": "d/x_1.png", "c": "d.v/x_1"}
    folders = spark.createDataFrame([("a",), ("a/b",), ("c",)], "path string")
    files = spark.createDataFrame([("a/x.png",), ("top.png",)], "path string")
    assert {r[0] for r in curation.empty_folders(folders, files).collect()} == {"a/b", "c"}
    turns = spark.createDataFrame([("m", 0, 1.0), ("m", 90, 2.0), ("n", 0, 2.0), ("n", 180, 2.5), ("o", 270, 0.5)], "image_id string, angle int, score double")
    assert dict(map(tuple, curation.best_rotation(turns).collect())) == {"m": 90, "n": 0, "o": 0}


def test_closest_agrees_with_difflib(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 9))).strip() or "a"
    keys, names = sorted({word() for _ in range(60)}), [word() for _ in range(80)] + ["", None]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    for cutoff in (0.6, 0.88):
        got = {r["name"]: r["close"] for r in tax.closest(rows, spark.createDataFrame([(k,) for k in keys], "key string"), cutoff).collect()}
        assert got == {n: (next(iter(difflib.get_close_matches(n, keys, 1, cutoff)), None) if n else None) for n in names}


def test_clean_names(spark):
    files = ["Picnic Area_png.rf.0a1b.png", "Picnc Area.png", "zzz.jpeg", "no dot"]
    known = spark.createDataFrame([("Picnic_Area.png",), ("Other.png",)], "key string")
    got = {r["file"]: (r["clean"], r["status"]) for r in curation.clean_names(spark.createDataFrame([(f,) for f in files], "file string"), known, "file").collect()}
    assert got == {files[0]: ("Picnic_Area.png", "exact"), files[1]: ("Picnic_Area.png", "fuzzy"), files[2]: ("zzz.jpeg", "none"), files[3]: ("no_dot", "none")}


def test_reason_counts(spark):
    rows = spark.createDataFrame([("below floor 0.51",), ("below floor 0.2",), ("below margin",), (None,)], "rejected string")
    assert {(r["cause"], r["n"]) for r in curation.reason_counts(rows).collect()} == {("below floor", 2), ("below margin", 1)}
