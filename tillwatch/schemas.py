"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, types and order of the message formats and tables.
RAW_TXN = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_lat", T.DoubleType()),
    T.StructField("merchant_lon", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# A broker message as a file source delivers it (same names as a Kafka source).
MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])

# A message that this package published to a file topic.
PUBLISHED = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

SCORED_TXN = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_lat", T.DoubleType()),
    T.StructField("merchant_lon", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("fraud_score", T.IntegerType()),
    T.StructField("is_flagged", T.BooleanType()),
    T.StructField("reasons", T.StringType()),
    T.StructField("k_topic", T.StringType()),
    T.StructField("k_partition", T.LongType()),
    T.StructField("k_offset", T.LongType()),
])

CUSTOMERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("plan", T.StringType()),
    T.StructField("avg_amount_30d", T.DoubleType()),
    T.StructField("credit_limit", T.DoubleType()),
])

RISK_PROFILES = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("avg_amount_30d", T.DoubleType()),
    T.StructField("stddev_amount", T.DoubleType()),
    T.StructField("avg_velocity_1h", T.DoubleType()),
    T.StructField("last_merchant_lat", T.DoubleType()),
    T.StructField("last_merchant_lon", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Where a user was last seen, as the scoring stream writes it.
LOCATIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("last_merchant_lat", T.DoubleType()),
    T.StructField("last_merchant_lon", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])

PROCESSED_BATCHES = T.StructType([
    T.StructField("batch_id", T.LongType(), nullable=False),
    T.StructField("processed_at", T.TimestampType()),
])

# Serving tables: bounded text and exact money, one row per key.
SERVING_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.VarcharType(64), nullable=False),
    T.StructField("user_id", T.VarcharType(64), nullable=False),
    T.StructField("amount", T.DecimalType(18, 2), nullable=False),
    T.StructField("merchant_id", T.VarcharType(64), nullable=False),
    T.StructField("merchant_lat", T.DoubleType()),
    T.StructField("merchant_lon", T.DoubleType()),
    T.StructField("status", T.VarcharType(20)),
    T.StructField("event_time", T.TimestampType(), nullable=False),
    T.StructField("ingest_time", T.TimestampType(), nullable=False),
    T.StructField("plan", T.VarcharType(20)),
    T.StructField("velocity_5min", T.IntegerType()),
    T.StructField("amount_zscore", T.DoubleType()),
    T.StructField("geo_speed_kmh", T.DoubleType()),
    T.StructField("fraud_score", T.IntegerType()),
    T.StructField("is_flagged", T.BooleanType()),
])

SERVING_FRAUD_SCORES = T.StructType([
    T.StructField("transaction_id", T.VarcharType(64), nullable=False),
    T.StructField("user_id", T.VarcharType(64), nullable=False),
    T.StructField("fraud_score", T.IntegerType(), nullable=False),
    T.StructField("reasons", T.VarcharType(500)),
    T.StructField("flagged_at", T.TimestampType(), nullable=False),
    T.StructField("reviewed", T.BooleanType()),
])

SERVING_RISK_PROFILES = T.StructType([
    T.StructField("user_id", T.VarcharType(64), nullable=False),
    T.StructField("avg_amount_30d", T.DecimalType(18, 2)),
    T.StructField("stddev_amount", T.DecimalType(18, 2)),
    T.StructField("avg_velocity_1h", T.DoubleType()),
    T.StructField("last_merchant_lat", T.DoubleType()),
    T.StructField("last_merchant_lon", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Message identity: one row of the history table per offset.
MESSAGE_KEY = ["k_topic", "k_partition", "k_offset"]

# One row per scored micro-batch, written after all its sinks.
LEDGER = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("total", T.LongType()),
    T.StructField("flagged", T.LongType()),
    T.StructField("geo_hits", T.LongType()),
])
