"""Windows cut by day give what the plain ones give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.operators.quantiles import quantiles
from pulse.operators.schedule import batches
from pulse.operators.windows import lag_by_day, position_in_order, row_number_over

START = datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds half of the rows; values repeat, and some are null."""
    pick = random.Random(7)
    rows = []
    for i in range(6000):
        key = "hot" if pick.random() < 0.5 else f"k{pick.randrange(300)}"
        rows.append((key, i, START + timedelta(minutes=17 * i), pick.choice([None, *range(40)])))
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "key string, at bigint, ts timestamp, value bigint")


def compare(got, expected):
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))


def test_lag(skewed):
    window = Window.partitionBy("key").orderBy("ts")
    expected = skewed.withColumn("before", F.lag("value").over(window))
    compare(lag_by_day(skewed, "key", "ts", "value", "before"), expected)


def test_lag_of_listed_keys(spark, skewed):
    dims = spark.createDataFrame([("hot", "a"), ("k1", "b"), ("none", "c")], "key string, name string")
    window = Window.partitionBy("key").orderBy("ts")
    expected = skewed.withColumn("before", F.lag("value").over(window)).join(dims, "key")
    compare(lag_by_day(skewed, "key", "ts", "value", "before", dims), expected)


def test_hot_key_is_spread_over_days(skewed):
    """No task of the window has more than a day of a key."""
    most = skewed.groupBy("key", F.to_date("ts")).count().agg(F.max("count")).first()[0]
    assert most <= 24 * 60 // 17 + 1


def test_row_number_with_size(skewed):
    window = Window.partitionBy("key").orderBy(F.col("value"), F.col("at"))
    expected = skewed.withColumn("n", F.row_number().over(window).cast("bigint")).withColumn(
        "size", F.count("*").over(Window.partitionBy("key"))
    )
    compare(row_number_over(skewed, ["key"], [F.col("value"), F.col("at")], "n", size="size"), expected)


def test_position_in_the_order_of_the_whole_table(skewed):
    expected = skewed.withColumn("n", F.row_number().over(Window.orderBy("value", "at")).cast("bigint"))
    for rows_per_range in (10, 10**6):
        compare(position_in_order(skewed, [F.col("value"), F.col("at")], "n", rows_per_range), expected)


def test_one_hot_hour_is_many_ranges(spark):
    """Items all read in one second are still numbered in ranges of a bounded size."""
    rows = spark.range(4000).select(F.sha1(F.col("id").cast("string")).alias("infohash"), F.lit(START).cast("timestamp").alias("last_scrape"))
    ranged = rows.repartitionByRange(16, "last_scrape", "infohash").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in ranged.collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 4000 / 16
    got = batches(rows, rows_per_range=250).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 4001))
    assert [r["infohash"] for r in got] == sorted(r["infohash"] for r in got)
    assert batches(rows.limit(0)).count() == 0


def test_batches_follow_the_scrape_order(spark):
    pick = random.Random(5)
    rows = [(f"{pick.getrandbits(160):040x}", None if i % 3 == 0 else START + timedelta(minutes=pick.randrange(600))) for i in range(200)]
    got = batches(spark.createDataFrame(rows, "infohash string, last_scrape timestamp")).orderBy("position").collect()
    expected = sorted(rows, key=lambda r: (r[1] is not None, r[1] or START, r[0]))
    assert [(r["infohash"], r["last_scrape"]) for r in got] == expected
    assert [r["position"] for r in got] == list(range(1, 201)) and [r["batch"] for r in got] == [i // 20 + 1 for i in range(200)]


@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_quantiles(skewed, method):
    got = {r["key"]: (r["p25"], r["p50"], r["p75"]) for r in
           quantiles(skewed, ["key"], "value", F.col("at"), method=method).collect()}
    values = {}
    for row in skewed.filter("value is not null").collect():
        values.setdefault(row["key"], []).append(row["value"])
    for key, found in values.items():
        found.sort()

        def at(q):
            position = (len(found) - 1) * q
            if method == "nearest":
                return float(found[int(position + 0.5)])
            low = int(position)
            high = min(low + 1, len(found) - 1)
            return found[low] + (found[high] - found[low]) * (position - low)

        assert got[key] == pytest.approx((at(0.25), at(0.5), at(0.75)))
