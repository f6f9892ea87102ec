"""Table definitions, loads, daily jobs and upkeep."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillwatch.operators import maintenance, profiles, quality
from tillwatch.operators.quality import QualityError
from tillwatch.plans import daily
from tillwatch.plans.tables import create_serving_tables, create_tables
from tillwatch.schemas import CUSTOMERS
from tillwatch.sources import events
from tillwatch.sources.events import AS_OF, at
from tillwatch.sources.tables import (
    customer_lines, load_customers, load_risk, or_empty, read_customers_csv, read_profiles,
)


@pytest.fixture(scope="module")
def databases(spark, tmp_path_factory):
    for _ in range(2):  # running the definitions twice changes nothing
        create_tables(spark, "lake")
        create_serving_tables(spark, "serving")
    return "lake", "serving"


def test_tables_have_their_columns_partitions_and_properties(spark, databases):
    lake = dict(spark.table("lake.transactions_lake").dtypes)
    assert lake["k_offset"] == "bigint" and lake["event_date"] == "date" and len(lake) == 16
    described = {r["col_name"]: r["data_type"] for r in
                 spark.sql("DESCRIBE EXTENDED serving.transactions").collect()}
    assert described["Num Buckets"] == "12" and described["amount"] == "decimal(18,2)"
    assert described["merchant_id"] == "varchar(64)"
    properties = {r["key"]: r["value"] for r in
                  spark.sql("SHOW TBLPROPERTIES lake.processed_batches").collect()}
    assert properties["write.metadata.previous-versions-max"] == "20"


def test_customer_file_load_replaces_the_table(spark, databases, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("user_id,plan,avg_amount_30d,credit_limit\nu1,BASIC,10.5,100\nu2,PREMIUM,x,\n")
    for _ in range(2):
        assert daily.load_customers_job(spark, str(path), "lake.customers") == {"rows": 2, "rejected": 0}
    assert rows(spark.table("lake.customers")) == [
        ("u1", "BASIC", 10.5, 100.0), ("u2", "PREMIUM", None, None)]
    assert read_customers_csv(spark, str(path)).dtypes == [
        (f.name, f.dataType.simpleString()) for f in CUSTOMERS]
    assert load_customers(spark, "lake.customers").columns == ["user_id", "plan", "avg_amount_30d"]


def test_broken_customer_lines_are_counted_and_left_out(spark, databases, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("plan,user_id,avg_amount_30d,credit_limit,line\nBASIC,u1,1,2,a\nBASIC,u2\n"
                    "BASIC,u3,1,2,a,more\nBASIC,,1,2,a\nBASIC,  ,1,2,a\n,u4,,,\n")
    assert daily.load_customers_job(spark, str(path), "lake.customers") == {"rows": 2, "rejected": 4}
    assert rows(load_customers(spark, "lake.customers")) == [("u1", "BASIC", 1.0), ("u4", None, None)]
    rejected = customer_lines(spark, str(path)).filter("rejected IS NOT NULL").select("rejected")
    assert [r[0] for r in rejected.collect()] == ["BASIC,u2", "BASIC,u3,1,2,a,more", "BASIC,1,2,a", "BASIC,  ,1,2,a"]
    path.write_text("user_id,plan,avg_amount_30d,credit_limit\n")
    assert daily.load_customers_job(spark, str(path), "lake.customers") == {"rows": 0, "rejected": 0}


def test_missing_dimension_is_empty_but_other_errors_are_raised(spark, tmp_path):
    assert load_customers(spark, "lake.no_such_table").isEmpty()
    assert load_risk(spark, str(tmp_path / "nowhere"), "parquet").isEmpty()
    with pytest.raises(AnalysisException):
        or_empty(spark, lambda: spark.range(1).select("no_such_column"), CUSTOMERS)


def test_daily_refresh_builds_verifies_and_copies(spark, databases, sf):
    txns = events.transactions(spark, sf)
    written = daily.daily_refresh(
        spark, txns, "serving.risk_profiles", "lake.risk_profiles", as_of=at(AS_OF), min_count=15)
    assert written == 15
    copied = load_risk(spark, "lake.risk_profiles")
    exact = profiles.risk_profiles(txns, at(AS_OF))
    both = copied.alias("c").join(exact.alias("e"), "user_id").selectExpr(
        "abs(c.avg_amount_30d - e.avg_amount_30d) <= 0.005 AS close",
        "c.avg_velocity_1h = e.avg_velocity_1h AS same")
    assert both.distinct().collect() == [(True, True)]
    stored = spark.table("serving.risk_profiles").inputFiles()[0].rsplit("/", 1)[0]
    assert rows(read_profiles(spark, "parquet", stored)) == rows(copied)
    with pytest.raises(QualityError, match="profile_min_count"):
        daily.daily_refresh(spark, txns, "serving.risk_profiles", "lake.risk_profiles",
                            as_of=at(AS_OF), min_count=16)


def test_one_transaction_has_no_spread(spark):
    df = spark.createDataFrame(
        [("u", 5.0, 1.0, 2.0, datetime(2024, 1, 30))],
        "user_id string, amount double, merchant_lat double, merchant_lon double, event_time timestamp")
    row = profiles.risk_profiles(df, at(AS_OF)).first()
    assert row["stddev_amount"] == 0.0 and row["avg_velocity_1h"] == pytest.approx(1 / 24)


def test_streamed_location_does_not_wipe_daily_features(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    daily_rows = spark.createDataFrame(
        [("a", 1.0, 2.0, 3.0, 10.0, 10.0, old), ("b", 1.0, 2.0, 3.0, 10.0, 10.0, new)],
        "user_id string, avg_amount_30d double, stddev_amount double, avg_velocity_1h double, "
        "last_merchant_lat double, last_merchant_lon double, updated_at timestamp")
    seen = spark.createDataFrame(
        [("a", 20.0, 21.0, new), ("b", 20.0, 21.0, old), ("c", 30.0, 31.0, new)],
        "user_id string, last_merchant_lat double, last_merchant_lon double, updated_at timestamp")
    assert rows(profiles.merge_profiles(daily_rows, seen)) == [
        ("a", 1.0, 2.0, 3.0, 20.0, 21.0, new), ("b", 1.0, 2.0, 3.0, 10.0, 10.0, new),
        ("c", None, None, None, 30.0, 31.0, new)]


def test_reconcile_passes_fresh_data_and_fails_old_or_empty(spark):
    schema = "event_time timestamp, ingest_time timestamp"
    now = datetime(2024, 1, 31)
    fresh = spark.createDataFrame([(now - timedelta(seconds=600), now)], schema)
    daily.reconcile(fresh, at(AS_OF))
    late = spark.createDataFrame([(now - timedelta(seconds=601), now - timedelta(hours=2))], schema)
    with pytest.raises(QualityError, match="freshness_lag.*recent_ingest_count"):
        daily.reconcile(late, at(AS_OF))
    empty = spark.createDataFrame([], schema)
    gate = quality.quality_gate([quality.stream_checks(empty, at(AS_OF))])
    assert rows(gate) == [("freshness_lag", None, 600, False), ("recent_ingest_count", 0, 1, False)]


def write_small_files(spark, sf, path, files):
    txns = events.transactions(spark, sf).withColumn("event_date", F.to_date("event_time"))
    txns.repartition(files).write.partitionBy("event_date").parquet(path)


def test_compaction_keeps_every_row_and_merges_files(spark, sf, tmp_path):
    path = str(tmp_path / "lake")
    write_small_files(spark, sf, path, 6)
    before = spark.read.parquet(path)
    expected, dates = rows(before), before.select("event_date").distinct().count()
    files = maintenance.list_files(spark, path).count()
    assert files > 100
    assert maintenance.compact(spark, path) == dates
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == expected
    assert maintenance.list_files(spark, path).count() <= dates + 1
    assert maintenance.compact(spark, path) == 0


def test_compaction_cuts_a_large_date_into_files_near_the_target(spark, sf, tmp_path):
    path = str(tmp_path / "lake")
    txns = events.transactions(spark, sf).withColumn("event_date", F.lit("2024-01-01").cast("date"))
    txns.repartition(40).write.partitionBy("event_date").parquet(path)
    listing = maintenance.list_files(spark, path)
    size = listing.agg(F.sum("bytes")).first()[0]
    needed = maintenance.partitions_to_compact(listing, "event_date", size // 5).first()["needed"]
    expected = rows(spark.read.parquet(path))
    assert maintenance.compact(spark, path, target_bytes=size // 5) == 1
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == expected
    assert 4 <= maintenance.list_files(spark, path).count() <= needed == 6


def test_fingerprint_sees_counts_not_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "n int, t string")
    assert maintenance.fingerprint(df) == maintenance.fingerprint(df.orderBy(F.desc("n")))
    assert maintenance.fingerprint(df) != maintenance.fingerprint(df.distinct())


def test_compaction_refuses_other_layouts(spark, tmp_path):
    path = str(tmp_path / "serving")
    df = spark.range(40).selectExpr("id", "id % 2 AS batch", "date'2024-01-01' AS event_date")
    df.repartition(4).write.partitionBy("batch", "event_date").parquet(path)
    expected = rows(spark.read.parquet(path))
    with pytest.raises(ValueError, match="not partitioned by event_date alone"):
        maintenance.compact(spark, path)
    assert rows(spark.read.parquet(path)) == expected


def test_compaction_keeps_what_a_writer_adds_meanwhile(spark, sf, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    write_small_files(spark, sf, path, 3)
    before = spark.read.parquet(path)
    expected, extra = rows(before), [tuple(r) for r in before.limit(1).collect()]
    schema, finish = before.schema, maintenance._finish

    def add_first(session, work):
        session.createDataFrame(extra, schema).write.mode("append").partitionBy("event_date").parquet(path)
        finish(session, work)

    monkeypatch.setattr(maintenance, "_finish", add_first)
    maintenance.compact(spark, path)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == sorted(expected + extra, key=repr)


@pytest.mark.parametrize("step", ["move", "delete"])
def test_a_crashed_compaction_is_finished_by_the_next(spark, sf, tmp_path, monkeypatch, step):
    path = str(tmp_path / "lake")
    write_small_files(spark, sf, path, 3)
    expected = rows(spark.read.parquet(path))
    real, calls = getattr(maintenance, step), []

    def crash(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("driver lost")
        return real(*args)

    monkeypatch.setattr(maintenance, step, crash)
    with pytest.raises(OSError, match="driver lost"):
        maintenance.compact(spark, path)
    monkeypatch.setattr(maintenance, step, real)
    maintenance.compact(spark, path)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == expected


def test_loads_are_published_whole_and_the_former_one_stays(spark, databases, tmp_path):
    path = tmp_path / "customers.csv"
    seen = []
    for number in range(4):
        path.write_text(f"user_id,plan,avg_amount_30d,credit_limit\nu{number},BASIC,1,1\n")
        before = load_customers(spark, "lake.customers")
        old = rows(before)
        daily.load_customers_job(spark, str(path), "lake.customers")
        assert rows(before) == old, "a reader lost its files"
        seen.append(rows(load_customers(spark, "lake.customers"), "user_id"))
    assert seen == [[(f"u{i}",)] for i in range(4)]


def test_a_failed_load_changes_nothing(spark, databases):
    expected = rows(spark.table("lake.customers"))
    broken = spark.range(1).selectExpr("cast(id AS string)", "'x'", "1.0D", "cast(raise_error('no') AS double)")
    with pytest.raises(Exception, match="no"):
        daily.overwrite(broken, "lake.customers")
    assert rows(spark.table("lake.customers")) == expected
    assert not [t.name for t in spark.catalog.listTables("lake") if "_load_" in t.name]


def test_hourly_check_counts_by_arrival(spark, tmp_path):
    """Old events that arrive now are rows that arrived."""
    from tillwatch.schemas import SERVING_TRANSACTIONS
    from tillwatch.streaming.sinks import Batch, Target, read_arrived, write_batch

    target = Target(str(tmp_path / "transactions"))
    df = spark.range(10).selectExpr(
        "cast(id AS string) AS transaction_id", "current_timestamp() - INTERVAL 3 DAYS AS event_time",
        "current_timestamp() AS ingest_time", "current_date() AS arrival_date")
    write_batch(df, target, Batch("q", 0), "arrival_date")
    since = F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    got = read_arrived(spark, target, ["transaction_id"], "ingest_time", since, SERVING_TRANSACTIONS)
    assert quality.recent_count(got).first()[0] == 10
    assert "arrival_date" in plan(got).split("PartitionFilters")[1].split("PushedFilters")[0]


def test_alerts_can_be_read_before_the_first_one(spark, tmp_path):
    from tillwatch.operators import serving
    from tillwatch.schemas import SERVING_FRAUD_SCORES
    from tillwatch.streaming.sinks import Target, read_current

    none = read_current(spark, Target(str(tmp_path / "no")), ["transaction_id"], "flagged_at", SERVING_FRAUD_SCORES)
    assert serving.recent_fraud_scores(none).count() == 0
