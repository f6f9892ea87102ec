"""Daily and hourly jobs: customer load, profile build, checks, history copy."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.maintenance import compact
from tillwatch.operators.profiles import merge_profiles, risk_profiles
from tillwatch.operators.quality import (
    MIN_PROFILES, profile_checks, require, stream_checks,
)
from tillwatch.schemas import CUSTOMERS, RISK_PROFILES, SERVING_RISK_PROFILES
from tillwatch.sources.files import children, delete
from tillwatch.sources.tables import LOADS, customer_lines, read_table, table_location
from tillwatch.streaming.sinks import conform


def overwrite(df: DataFrame, table: str, schema: T.StructType | None = None) -> int:
    """Replace the content of a catalog table and return the rows written, counted
    during the write. Columns are taken by position, as INSERT OVERWRITE does.

    A table of plain files gets each load in a folder of its own, which is published last by
    pointing the table to it. Readers see the old load or the new one, and the load before
    stays for queries that are reading it. Other formats have snapshots of their own.
    """
    spark = df.sparkSession
    rows = Observation("load_count")
    df = conform(df, schema) if schema is not None else df
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    location = table_location(spark, table)
    if location is None:
        counted.write.insertInto(table, overwrite=True)
        return int(rows.get["rows"])
    home = location.rsplit("/", 1)[0] if LOADS in location else location.rstrip("/") + LOADS
    fresh = f"{home}/load-{uuid.uuid4().hex}"
    staged = f"{table}_load_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {staged} LIKE {table} LOCATION '{fresh}'")
    try:
        counted.write.insertInto(staged)
    finally:
        spark.sql(f"DROP TABLE {staged}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    for old in children(spark, home):
        if old.rsplit("/", 1)[1] not in (fresh.rsplit("/", 1)[1], location.rsplit("/", 1)[1]):
            delete(spark, old)
    return int(rows.get["rows"])


def load_customers_job(spark: SparkSession, csv_path: str, table: str) -> dict[str, int]:
    """Customer file to the customer table: ``rows`` written and lines ``rejected``, both
    counted during the write."""
    read = Observation("customer_lines")
    lines = customer_lines(spark, csv_path).observe(read, F.count("rejected").alias("rejected"))
    rows = overwrite(lines.filter("rejected IS NULL").drop("rejected"), table, CUSTOMERS)
    return {"rows": rows, "rejected": int(read.get["rejected"])}


def refresh_profiles(txns: DataFrame, table: str, as_of: Column | None = None) -> int:
    """Rebuild the serving profiles from the last 30 days; money is rounded here."""
    return overwrite(risk_profiles(txns, as_of), table, SERVING_RISK_PROFILES)


def sync_profiles(profiles: DataFrame, table: str) -> int:
    """Copy the serving profiles to the history side, where the scoring stream reads."""
    return overwrite(profiles, table, RISK_PROFILES)


def verify_profiles(
    profiles: DataFrame, as_of: Column | None = None, min_count: int = MIN_PROFILES
) -> None:
    require(profile_checks(profiles, as_of, min_count))


def daily_refresh(
    spark: SparkSession,
    txns: DataFrame,
    serving_table: str,
    lake_table: str,
    history_path: str | None = None,
    as_of: Column | None = None,
    min_count: int = MIN_PROFILES,
    locations: DataFrame | None = None,
) -> int:
    """Refresh, verify, copy, compact, in this order. A failed check stops the rest. With
    ``locations`` (the newest each user was streamed at) the copy that scoring reads has a
    streamed place where that is newer than the profile."""
    refresh_profiles(txns, serving_table, as_of)
    verify_profiles(read_table(spark, serving_table), as_of, min_count)
    built = read_table(spark, serving_table)
    rows = sync_profiles(
        built if locations is None else merge_profiles(built, locations), lake_table)
    if history_path:
        compact(spark, history_path)
    return rows


def reconcile(txns: DataFrame, as_of: Column | None = None) -> None:
    """Hourly: the stream is fresh, then rows arrived. Raises when not."""
    require(stream_checks(txns, as_of))
