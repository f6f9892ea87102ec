"""Message payloads: key and JSON value of each outgoing topic. NULL fields are left
out of the JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.schemas import SCORED_TXN

# Microseconds, so that no time is cut on its way through a topic.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Field names and order of the clean topic, the alerts and the dead letters.
CLEAN_FIELDS = [
    "transaction_id", "user_id", "amount", "merchant_id", "status",
    "event_time", "plan", "fraud_score", "is_flagged",
]
ALERT_FIELDS = ["transaction_id", "user_id", "amount", "fraud_score", "reasons", "flagged_at"]
DLQ_FIELDS = ["reason", "topic", "partition", "offset", "ingest_time", "raw_json"]


def _message(df: DataFrame, key: str, fields: list[str | Column]) -> DataFrame:
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields), TIMES).alias("value")
    )


def alerts_payload(scored: DataFrame) -> DataFrame:
    """Flagged rows, keyed by user so that a user's alerts keep their order."""
    raised = scored.filter("is_flagged").withColumn("flagged_at", F.col("ingest_time").cast("string"))
    return _message(raised, "user_id", ALERT_FIELDS)


def clean_payload(scored: DataFrame) -> DataFrame:
    """Every accepted row, keyed by user."""
    return _message(scored, "user_id", CLEAN_FIELDS)


def scored_payload(scored: DataFrame) -> DataFrame:
    """Every scored row with its message identity; the history writer reads this."""
    return _message(scored, "transaction_id", SCORED_TXN.fieldNames())


def dlq_payload(bad: DataFrame) -> DataFrame:
    """Rejected messages with their reason, position and original text."""
    named = bad.select(
        F.col("dlq_reason").alias("reason"), F.col("k_topic").alias("topic"),
        F.col("k_partition").alias("partition"), F.col("k_offset").alias("offset"),
        F.col("ingest_time").cast("string").alias("ingest_time"), "raw_json",
    )
    return named.select(F.to_json(F.struct(*DLQ_FIELDS)).alias("value"))
