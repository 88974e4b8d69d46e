"""The pipeline's stages against what each is to do, and all of them in a row."""

import random

import pytest

import corpus_pipeline as cp
from cartolink.llm import registry

from .test_operators import brute_jaccard, brute_lines


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path = random.Random(9), tmp_path_factory.mktemp("sf")
    words = ["".join(rng.choice("aeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    item = prose(30)
    rows = [(k, prose(60) + ".", "en", f"s{k % 3}") for k in range(150)]
    rows += [(200 + k, prose(50).upper().replace(" ", "!! "), "en", "s0") for k in range(40)]
    rows += [(300, rows[5][1], "en", "s1"), (301, rows[6][1].replace(" ", "\n", 1), "en", "s1"), (302, prose(20) + "\n" + item, "en", "s2")]
    docs = [(*r, len(r[1])) for r in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(not 200 <= i < 300), 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = cp.quality_classifier(spark, docs, folder)
    ids = {r[0] for r in rows_of(clean)}
    assert ids >= set(range(150)) and len(ids & set(range(200, 240))) <= 2 and clean.columns == docs.columns
    left = {(i, t) for i, t, _ in rows_of(cp.line_dedup(spark, docs, folder))}
    expected = brute_lines(rows_of(docs))
    assert left == {(i, now) for (i, was), now in expected.items() if now.strip() or not was.strip()}
    groups = {i: c for i, _, c in brute_jaccard(rows_of(docs), 5, 80, 100)}
    assert {r[0] for r in rows_of(cp.ngram_jaccard(spark, docs, folder))} == {i for i, c in groups.items() if i == c}
    assert {i for i, *_ in rows_of(docs)} - {r[0] for r in rows_of(cp.decontamination(spark, docs, folder))} == {302}
    mixed = cp.mix_sources(spark, docs, folder)
    assert mixed.where("taken < 1 or taken > 3 * size").count() == 0 and mixed.count() > 100


def test_null_and_repeated_ids(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choices("aeilnorst", k=6)) for _ in range(n))
    text, other, same = prose(40), prose(40), prose(40)
    rows = [(None, text, "s0"), (None, other, "s1"), (7, same, "s0"), (7, same, "s0"), (7, prose(30), "s0"), (8, text, "s0"), (9, "", "s0"), (9, "", "s0")]
    odd = lambda more: spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows + more], docs.schema)
    # Copies of one id, and a copy without an id, go; texts of one id that differ stay.
    near = sorted(rows_of(cp.ngram_jaccard(spark, odd([]), folder)), key=str)
    assert near == sorted([rows[1], rows[2], rows[4], rows[5], rows[6], rows[7]], key=str)
    bad = [(None, prose(5) + " " + item, "s0"), (8, item, "s1")]
    assert sorted(rows_of(cp.decontamination(spark, odd(bad), folder)), key=str) == sorted(rows, key=str)
    mixed = cp.mix_sources(spark, odd([]), folder)
    found = cp.mix.mix(odd([])).where("taken > 0")
    words = lambda df: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in df.collect())
    assert words(mixed) == words(found) and mixed.where("doc_id is null").count() > 0
    assert mixed.where("size <> size(split(text, ' '))").count() == 0


def test_run(spark, folder):
    got = cp.run(spark, folder)
    ids = {r[0] for r in rows_of(got)}
    assert ids and not ids & {300, 302} and len(ids & set(range(200, 240))) <= 2
    assert [name for name, _ in cp.STAGES] and len(cp.STAGES) == 5


def test_registry():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 11)} and set(registry.oracle_sql()) <= names
