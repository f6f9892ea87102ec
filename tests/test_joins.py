"""Both join paths give the same rows, whatever the distribution of keys."""

from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillwatch.config import JoinPolicy
from tillwatch.operators.joins import (
    hot_keys, latest_by_key, left_join_unique, measure, salted_left_join,
)

SHUFFLED = JoinPolicy(max_broadcast_rows=0, hot_rows=50, hot_keys=3)


@pytest.fixture(scope="module")
def facts(spark):
    """One key holds a third of 3000 rows, some rows have no key."""
    return spark.range(3000).select(
        F.col("id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL "
               "ELSE concat('u', id % 97) END").alias("user_id"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("hot", 1.0)] + [(f"u{i}", float(i)) for i in range(0, 97, 2)], "user_id string, v double"
    )


def test_salted_join_equals_plain_left_join(facts, dim):
    expected = rows(facts.join(dim, "user_id", "left"), "id", "user_id", "v")
    assert rows(salted_left_join(facts, dim, ["user_id"], SHUFFLED), "id", "user_id", "v") == expected
    assert rows(left_join_unique(facts, dim, ["user_id"]), "id", "user_id", "v") == expected
    assert len(expected) == 3000


def test_size_decides_between_broadcast_and_shuffle(facts, dim):
    assert "_salt" not in left_join_unique(facts, dim, ["user_id"])._jdf.queryExecution().toString()
    shuffled = left_join_unique(facts, dim, ["user_id"], SHUFFLED)
    assert "_salt" in shuffled._jdf.queryExecution().toString()


def test_hot_key_list_is_bounded_and_salts_follow_the_count(facts):
    hot = {r["user_id"]: r["_salts"] for r in hot_keys(facts, ["user_id"], SHUFFLED).collect()}
    assert len(hot) <= SHUFFLED.hot_keys
    assert hot["hot"] == 20


def test_hot_rows_land_in_many_tasks(spark, facts, dim):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    former = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = salted_left_join(facts, dim, ["user_id"], SHUFFLED)
        placed = joined.select("user_id", F.spark_partition_id().alias("task"))
        per_task = {tuple(r) for r in placed.distinct().collect()}
        assert len([t for user, t in per_task if user == "hot"]) == 4
        assert len([t for user, t in per_task if user is None]) == 4
    finally:
        for key, value in former.items():
            spark.conf.set(key, value)


def test_measure_counts_rows_and_text(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "t string, n int")
    size = measure(df)
    assert (size.rows, size.bytes) == (2, 2 * 32 + 2)
    assert measure(df.filter("n > 9")).rows == 0


def test_latest_by_key_limits_each_task_before_the_shuffle(facts):
    newest = latest_by_key(facts, ["user_id"], ["id"])
    text = plan(newest)
    assert "WindowGroupLimit" in text and "Partial" in text
    got = {r["user_id"]: r["id"] for r in newest.collect()}
    assert got["hot"] == 2997


def test_nested_columns_are_measured_by_what_they_hold(spark):
    d = spark.createDataFrame(
        [(1, "abc", [1, 2, 3], ["xx", None], [("a", 1)], {"k": [1, 2]}), (2, None, None, [], None, None)],
        "n int, t string, a array<long>, s array<string>, r array<struct<x: string, y: long>>, m map<string, array<long>>")
    size = measure(d)
    first = 6 * 16 + 3 + 3 * 16 + (2 * 16 + 2) + (16 + 2 * 16 + 1) + (16 + 1 + 16 + 2 * 16)
    assert size.rows == 2 and size.bytes == first + 6 * 16
    long = spark.range(10).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"))
    assert measure(long).bytes == 10 * (16 + 16_000)
