"""Transactions, messages and dimension tables derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.joins import latest_by_key
from tillwatch.schemas import RAW_TXN
from tillwatch.sources.messages import RAW_TOPIC

# ``ts`` is stored without a zone; read as a UTC instant its filters reach the scan.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Reference times of the derived data.
RISK_CUTOFF = "2024-01-20 00:00:00"
AS_OF = "2024-01-31 00:00:00"
AS_OF_HOUR = "2024-01-30 23:57:13"


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event, with the identity of the message that carried it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _from_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def message_stream(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """The events as a stream of raw messages."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A pattern, because a stream takes folders or patterns but no single file.
    events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events*.parquet")
    return messages(_from_events(events), corrupt)


def _from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "CAST(event_id AS STRING) AS transaction_id",
        "format_string('user_%04d', user_id) AS user_id",
        "value AS amount",
        "format_string('merchant_%04d', CAST(get_json_object(props, '$.k') AS INT)) AS merchant_id",
        "IF(event_id % 50 != 0, ((event_id * 7919) % 18000) / 100.0D - 90, NULL) AS merchant_lat",
        "IF(event_id % 50 != 0, ((event_id * 104729) % 36000) / 100.0D - 180, NULL) AS merchant_lon",
        "event_type AS status",
        "ts AS event_time",
        "ts + INTERVAL 2 SECONDS AS ingest_time",
        f"'{RAW_TOPIC}' AS k_topic",
        "event_id % 6 AS k_partition",
        "event_id div 6 AS k_offset",
    )


def customers(txns: DataFrame) -> DataFrame:
    """Customers with their average spend; every 25th user is left out so that some
    transactions find none."""
    number = "CAST(substring_index(user_id, '_', -1) AS BIGINT) + 1"
    return (
        txns.filter(f"({number}) % 25 != 0")
        .groupBy("user_id").agg(F.avg("amount").alias("avg_amount_30d"))
        .selectExpr(
            "user_id",
            f"elt(CAST(({number}) % 3 + 1 AS INT), 'PREMIUM', 'BASIC', 'PREPAID') AS plan",
            "avg_amount_30d",
            "avg_amount_30d * 10 AS credit_limit",
        )
    )


def risk(txns: DataFrame) -> DataFrame:
    """Where each user was last seen before the cutoff."""
    before = txns.filter(f"event_time < TIMESTAMP '{RISK_CUTOFF}'")
    newest = latest_by_key(before, ["user_id"], ["event_time", F.col("transaction_id").asc()])
    return newest.selectExpr(
        "user_id",
        "CAST(NULL AS DOUBLE) AS avg_amount_30d",
        "CAST(NULL AS DOUBLE) AS stddev_amount",
        "CAST(NULL AS DOUBLE) AS avg_velocity_1h",
        "merchant_lat AS last_merchant_lat",
        "merchant_lon AS last_merchant_lon",
        "event_time AS updated_at",
    )


def messages(txns: DataFrame, corrupt: bool = False) -> DataFrame:
    """Raw messages of the transactions (topic, partition, offset, value). With
    ``corrupt`` the rows with event id 0..8 modulo 101 are broken in nine ways."""
    fields = {name: F.col(name) for name in RAW_TXN.fieldNames() if name != "timestamp"}
    fields["timestamp"] = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    kind = F.col("transaction_id").cast("long") % 101
    if corrupt:
        fields["transaction_id"] = F.when(kind == 7, "").otherwise(fields["transaction_id"])
        fields["user_id"] = F.when(kind != 1, fields["user_id"])
        fields["amount"] = (
            F.when(kind == 2, 0.0).when(kind == 3, -1.0).when(kind != 8, fields["amount"])
        )
        fields["merchant_id"] = F.when(kind == 4, "").otherwise(fields["merchant_id"])
        fields["timestamp"] = F.when(kind == 5, "nope").otherwise(fields["timestamp"])
    text = F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
    if corrupt:
        text = F.when(kind == 0, "{bad").when(kind != 6, text)
    return txns.select(
        F.col("k_topic").alias("topic"),
        F.col("k_partition").cast("int").alias("partition"),
        F.col("k_offset").alias("offset"),
        text.alias("value"),
        "event_time",
    )
