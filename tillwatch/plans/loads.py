"""The daily loads as queries: files and tables written, published, and read by their loaders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.plans import daily
from tillwatch.schemas import CUSTOMERS, RISK_PROFILES, SERVING_RISK_PROFILES
from tillwatch.session import scratch_path
from tillwatch.sources import events
from tillwatch.sources.events import AS_OF, at
from tillwatch.sources.tables import load_customers, load_risk, read_table

# Where the events end that the first of two customer files is made of.
FIRST_LOAD = "2024-01-15 00:00:00"


def _table(spark: SparkSession, name: str, schema: T.StructType) -> str:
    """A table over a scratch folder. Its files outlive its entry in the catalog."""
    table = f"{name}_{uuid.uuid4().hex}"
    spark.catalog.createTable(table, path=scratch_path(spark, name), source="parquet", schema=schema)
    return table


def _customer_file(customers: DataFrame, path: str) -> None:
    """A file with header, in which the lines of users ending in 3 lack fields and those of
    users ending in 7 have one too many. One text column, so that nothing is quoted."""
    last = F.substring("user_id", -1, 1)
    line = F.when(last == "3", F.concat_ws(",", "user_id", "plan")).otherwise(F.concat_ws(
        ",", "user_id", "plan", "avg_amount_30d", "credit_limit", F.when(last == "7", F.lit("more"))))
    customers.select(line.alias(",".join(CUSTOMERS.names))).write.csv(path, header=True, sep="\t")


def customer_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as the scoring stream loads them after two published loads, and the counts
    of the second."""
    txns = events.transactions(spark, sf_dir)
    table = _table(spark, "customers", CUSTOMERS)
    try:
        for part in (txns.filter(F.col("event_time") < at(FIRST_LOAD)), txns):
            path = scratch_path(spark, "customers-csv")
            _customer_file(events.customers(part), path)
            counts = daily.load_customers_job(spark, path, table)
        loaded = load_customers(spark, table)
    finally:
        spark.sql(f"DROP TABLE {table}")
    return loaded, spark.range(1).select(
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def profile_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles built into the serving table, copied by position and loaded for scoring."""
    serving = _table(spark, "serving", SERVING_RISK_PROFILES)
    history = _table(spark, "profiles", RISK_PROFILES)
    try:
        daily.refresh_profiles(events.transactions(spark, sf_dir), serving, at(AS_OF))
        daily.sync_profiles(read_table(spark, serving), history)
        return load_risk(spark, history)
    finally:
        for table in (serving, history):
            spark.sql(f"DROP TABLE {table}")
