"""Files that queries write for sources to read: as many as there are rows for, none gathered in memory."""

import glob
import math
import tracemalloc
import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest

from pulse.functions.ratios import fold_width
from pulse.queries import ingestion, registry
from pulse.sources import listing
from tests.conftest import SF_DIR


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    """Small files, in a folder that can be looked at."""
    monkeypatch.setattr(ingestion, "FILE_LINES", 100)
    folders = iter(range(9))
    monkeypatch.setattr(ingestion, "_scratch", lambda spark: f"{tmp_path}/{next(folders)}")
    return str(tmp_path)


def _items(path):
    files = glob.glob(f"{path}/again=*/page=*/*.txt")
    return [len(ET.parse(f).getroot().findall(".//item")) for f in files]


def test_feed_documents_grow_in_number(spark, scratch):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    got = registry.queries["feed_files"](spark, SF_DIR)
    assert got.count() == registry.queries["feed_rows"](spark, SF_DIR).count()
    sizes = _items(f"{scratch}/0")
    assert len(sizes) == math.ceil(orders / 100) and sum(sizes) == orders and max(sizes) < 200


def test_streamed_documents_grow_in_number(spark, scratch):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    got = registry.queries["stream_feed"](spark, SF_DIR)
    assert got.count() == registry.queries["feed_rows"](spark, SF_DIR).count()
    sizes = _items(f"{scratch}/0")
    assert len(sizes) == 2 * math.ceil(orders / 100) and sum(sizes) == 2 * orders and max(sizes) < 200
    assert len(glob.glob(f"{scratch}/1/state/commits/[0-9]*")) <= 5


def test_streamed_items_are_stored_with_their_names(spark, scratch):
    """Names are parsed once an item is known to be new; an item listed twice has its name like any other."""
    registry.queries["stream_feed"](spark, SF_DIR)
    wanted = ingestion._feed_rows(spark, SF_DIR).select("infohash", "guessit_data")
    got = spark.read.parquet(f"{scratch}/1/rows").select("infohash", "guessit_data")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_survey_files_grow_in_number(spark, scratch):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    got = registry.queries["survey_files"](spark, SF_DIR)
    wanted = registry.queries["survey_rows"](spark, SF_DIR).collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted))
    texts = [open(f).read().splitlines() for f in glob.glob(f"{scratch}/0/again=*/page=*/*.txt")]
    assert len(texts) == math.ceil(lines / 100) and sum(map(len, texts)) == lines + len(texts)
    assert all(t[0] == ",".join(ingestion._HEADERS) for t in texts) and max(map(len, texts)) < 200


def test_listing_patterns_are_not_matched_again_by_filters(spark):
    rows = listing.listing_rows(spark.createDataFrame([("<html></html>",)], "html string"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if " Filter " in line]
    assert filters and not any("regexp" in f or "RLIKE" in f for f in filters)


def test_few_texts_at_a_time_are_folded():
    """A batch of long texts is not in Python's memory as a whole."""
    texts = pa.array([None if i % 9 == 0 else f"Ｒ{i}ゼロ" * 10_000 for i in range(640)])
    size = texts.nbytes
    tracemalloc.start()
    folded = fold_width.func(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert folded[1].as_py() == "R1ゼロ" * 10_000 and folded[0].as_py() is None and len(folded) == 640
    assert peak < size / 2
