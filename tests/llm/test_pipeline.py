import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from pulse.llm import packing, pseudonyms
from pulse.llm.common import components, numbered, table, whole_groups
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, SF_DIR))
        out.append((name, before, docs))
    return out


def test_stages_return_documents(spark, stages):
    columns = table(spark, SF_DIR, "documents").columns
    for name, before, after in stages[:-1]:
        assert after.columns == columns, name
        assert after.schema == before.schema, name


def test_quality_keeps_good_documents(spark, stages):
    _, before, after = stages[0]
    labels = table(spark, SF_DIR, "labels")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("quality = 1").count() <= 0.1 * labels.where("quality = 1").count()
    assert gone.where("quality = 0").count() > 0


def test_dedup_leaves_one_of_each_text(stages):
    _, before, after = stages[1]
    assert after.groupBy("text").count().where("count > 1").count() == 0
    assert after.count() <= before.select("text").distinct().count()


def test_pii_is_as_the_plain_function(stages):
    _, before, after = stages[2]
    want = {r.doc_id: pseudonyms.replace(r.text, b"rotate-me")[0] for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0


def test_mix_takes_whole_or_cut_texts(stages):
    _, before, after = stages[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.text.strip() in texts[r.doc_id]


def test_packing_covers_every_row(stages):
    _, before, after = stages[4]
    path = corpus_pipeline.tokenizer_path()
    total = sum(len(packing.encode(path, r.text)) + 1 for r in before.select("text").collect())
    got = after.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert got[0] == total and got[1] <= 1.05 * total / 1024 + 2


def test_stages_survive_an_empty_table(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_queries_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 420)] + [(1, 2), (2, 1), (3, 3)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(300, 420)]} | {1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_numbered_counts_within_keys(spark):
    rows = [(0, i) for i in range(500)] + [(1, i) for i in range(3)] + [(2, 5)] * 4
    got = numbered(spark.createDataFrame(rows, "k int, v int"), "k", ["v"], rows_per_task=20).collect()
    for key, n in ((0, 500), (1, 3), (2, 4)):
        assert sorted(r["rank"] for r in got if r.k == key) == list(range(n))


def test_whole_groups_are_not_cut():
    import pandas as pd

    frame = pd.DataFrame({"k": [0, 0, 1, 1, 1, 2, 3, 3], "v": range(8)})
    parts = list(whole_groups((frame.iloc[i : i + 2] for i in range(0, 8, 2)), ["k"]))
    assert pd.concat(parts)["v"].tolist() == list(range(8))
    seen = [set(p["k"]) for p in parts]
    assert all(not (a & b) for i, a in enumerate(seen) for b in seen[:i])
