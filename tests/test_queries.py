"""Every registered query against its SQL, dashboard edge cases, and plan checks."""

from __future__ import annotations

import importlib.util
from datetime import datetime
from pathlib import Path

import pytest
from conftest import TESTDATA, plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tillwatch.operators import serving
from tillwatch.operators.quality import freshness
from tillwatch.operators.stats import running_totals, running_totals_in_blocks
from tillwatch.sources.events import AS_OF, at

ROOT = Path(__file__).resolve().parents[1]
_spec = importlib.util.spec_from_file_location("compare", ROOT / "tools" / "compare.py")
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)

QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.tables(TESTDATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, TESTDATA).toPandas()
    theirs = duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert compare.rows(ours) == compare.rows(theirs)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_empty_hour_gives_zero_and_nulls(spark):
    df = spark.createDataFrame(
        [], "event_time timestamp, ingest_time timestamp, is_flagged boolean, fraud_score int")
    stats = serving.with_flag_rate(serving.dashboard_stats(df, at(AS_OF)))
    assert rows(stats) == [(0, None, None, None, None)]
    assert rows(serving.stat_cards(stats)) == [("0", "—", "—", "—")]
    assert rows(freshness(df, at(AS_OF))) == [(None,)]


def test_stat_cards_show_one_decimal(spark):
    stats = spark.createDataFrame(
        [(3, 1, 20.0)], "total_transactions long, flagged_count long, avg_fraud_score double")
    assert rows(serving.stat_cards(stats)) == [("3", "1", "20.0", "33.3%")]


@pytest.mark.parametrize("n", [0, 1001])
def test_limits_are_checked(spark, n):
    df = spark.createDataFrame(
        [], "transaction_id string, user_id string, fraud_score int, reasons string, flagged_at timestamp")
    with pytest.raises(ValueError, match="between 1 and 1000"):
        serving.recent_fraud_scores(df, n)
    with pytest.raises(ValueError, match="between 1 and 1000"):
        serving.top_risky_users(df, at(AS_OF), n)


def test_alerts_are_presented(spark):
    df = spark.createDataFrame(
        [("0123456789", 100, datetime(2024, 1, 1, 10, 11, 12))],
        "transaction_id string, fraud_score int, flagged_at timestamp")
    row = serving.present_alerts(df).first()
    assert (row["short_id"], row["display_time"], row["chart_time"], row["band"]) == (
        "01234567", "2024-01-01 10:11:12", "10:11:12", "critical")


def test_running_totals_keep_queries_apart(spark):
    ledger = spark.range(0, 20).select(
        F.expr("concat('q', id % 2)").alias("query_id"), F.expr("id div 2").alias("batch_id"),
        F.lit(1).alias("total"), F.lit(2).alias("flagged"), F.lit(3).alias("geo_hits"))
    got = {(r["query_id"], r["batch_id"]): (r["acc_total"], r["acc_geo_hits"])
           for r in running_totals(ledger).collect()}
    assert got == {(q, i): (i + 1, 3 * (i + 1)) for q in ("q0", "q1") for i in range(10)}
    assert plan(running_totals(ledger)).count("Exchange") == 1


def test_running_totals_in_blocks_equal_those_in_one_piece(spark):
    ledger = spark.range(0, 4000).filter("id % 13 <> 5").select(
        F.expr("concat('q', id % 2)").alias("query_id"), F.expr("id div 2 - 700").alias("batch_id"),
        F.expr("id % 7").alias("total"), F.expr("id % 3").alias("flagged"), F.expr("id % 5").alias("geo_hits"))
    blocked = running_totals_in_blocks(ledger, 64)
    assert rows(blocked) == rows(running_totals(ledger))
    # The ledger itself is shuffled by query and block alone, and only block totals by query.
    text = plan(blocked)
    assert "hashpartitioning(query_id" in text and "batch_id" not in "".join(
        line for line in text.splitlines() if "hashpartitioning" in line)
    assert rows(running_totals_in_blocks(ledger.limit(0))) == []


# Plans ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_cross_join(spark, name):
    if name in ORACLES:
        text = plan(QUERIES[name](spark, TESTDATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text and "Pandas" not in text


def test_time_filters_reach_the_scan(spark):
    text = plan(QUERIES["recent_window_filter"](spark, TESTDATA))
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in text


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(QUERIES["freshness_lag"](spark, TESTDATA))
    assert "ReadSchema: struct<ts:timestamp>" in text
    text = plan(QUERIES["velocity_trailing"](spark, TESTDATA))
    assert "props" not in text and "value" not in text


def test_top_lists_sort_only_what_they_return(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["recent_fraud_scores"](spark, TESTDATA))
    assert "TakeOrderedAndProject" in plan(QUERIES["top_risky_users"](spark, TESTDATA))


def test_newest_rows_are_cut_before_the_shuffle(spark):
    for name in ("latest_per_user", "latest_by_key", "merge_anti"):
        text = plan(QUERIES[name](spark, TESTDATA))
        assert "WindowGroupLimit" in text and "Partial" in text, name


def test_scoring_reads_the_wide_rows_once(spark):
    """Newest time, count and dimensions take a few columns; the rows themselves are read once."""
    scans = plan(QUERIES["sink_transactions"](spark, TESTDATA)).split("FileScan")[1:]
    schemas = [scan.split("ReadSchema: ")[1].split("\n")[0] for scan in scans]
    assert sum("event_type" in schema for schema in schemas) == 1 and len(schemas) <= 5


def test_a_message_is_parsed_once(spark):
    """Filters on parsed fields must not repeat the parse."""
    from tillwatch.operators.ingest import validated
    from tillwatch.sources import events

    good, bad = validated(events.messages(events.transactions(spark, TESTDATA), corrupt=True))
    for side in (good, bad, good.select("user_id", "event_time")):
        assert plan(side).count("from_json(") == 1


def test_queries_without_the_optional_operators(monkeypatch):
    """A library that only the training-data operators need may be missing."""
    import sys

    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n.startswith("tillwatch.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    import tillwatch
    monkeypatch.delattr(tillwatch, "llm", raising=False)
    for missing in ("zstandard", "public_tokenizers"):
        monkeypatch.setitem(sys.modules, missing, None)
    assert set(entry.queries()) == set(entry.QUERIES) and set(entry.oracle_sql()) <= set(entry.QUERIES)
