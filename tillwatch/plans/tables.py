"""Table definitions of the history and serving side, as idempotent SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tillwatch.schemas import (
    CUSTOMERS, PROCESSED_BATCHES, RISK_PROFILES, SCORED_TXN, SERVING_FRAUD_SCORES,
    SERVING_RISK_PROFILES, SERVING_TRANSACTIONS,
)

# Upkeep properties of the tables that grow, key and buckets of serving.
UPKEEP = {
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "20",
}
SERVING = {
    "transactions": (SERVING_TRANSACTIONS, "transaction_id", 12),
    "fraud_scores": (SERVING_FRAUD_SCORES, "transaction_id", 6),
    "risk_profiles": (SERVING_RISK_PROFILES, "user_id", 6),
}


def _columns(schema: T.StructType) -> str:
    return ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"'{key}' = '{value}'" for key, value in values.items())


def _location(root: str | None, name: str) -> str:
    return f" LOCATION '{root.rstrip('/')}/{name}'" if root else ""


def create_tables(
    spark: SparkSession, database: str, fmt: str = "parquet", root: str | None = None
) -> None:
    """Create the history tables where they do not exist, and set the upkeep properties
    again on those that grow. Running it twice changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    by_day = "days(event_time)" if fmt == "iceberg" else "event_date"
    history = SCORED_TXN if fmt == "iceberg" else T.StructType(
        [*SCORED_TXN.fields, T.StructField("event_date", T.DateType())]
    )
    tables = {
        "customers": (CUSTOMERS, ""),
        "transactions_lake": (history, f" PARTITIONED BY ({by_day})"),
        "processed_batches": (PROCESSED_BATCHES, ""),
        "risk_profiles": (RISK_PROFILES, ""),
    }
    for name, (schema, partitioning) in tables.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema)}) "
            f"USING {fmt}{partitioning}{_location(root, name)}"
        )
    for name in ("transactions_lake", "processed_batches"):
        spark.sql(f"ALTER TABLE {database}.{name} SET TBLPROPERTIES ({_properties(UPKEEP)})")


def create_serving_tables(
    spark: SparkSession, database: str, fmt: str = "parquet", root: str | None = None
) -> None:
    """Create the serving tables: bounded text, exact money, bucketed by their key, so
    joins and upserts on the key need no shuffle of the table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, key, buckets) in SERVING.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema)}) USING {fmt} "
            f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS{_location(root, name)} "
            f"TBLPROPERTIES ('primary_key' = '{key}')"
        )
