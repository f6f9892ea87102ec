"""Message streams: the raw topic and the scored topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.payloads import TIMES
from tillwatch.schemas import MESSAGE, PUBLISHED, SCORED_TXN

# Topic names and the default rows taken per trigger.
RAW_TOPIC = "transactions-raw"
DLQ_TOPIC = "transactions-dlq"
CLEAN_TOPIC = "transactions-clean"
ALERTS_TOPIC = "fraud-alerts"
SCORED_TOPIC = "transactions-scored"
ROWS_PER_TRIGGER = 50_000


def _read_stream(
    spark: SparkSession, fmt: str, location: str, schema: T.StructType, rate_cap: int | None,
    options: Mapping[str, str] | None,
) -> DataFrame:
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = (
            reader.option("subscribe", location)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
            .option("maxOffsetsPerTrigger", rate_cap or ROWS_PER_TRIGGER)
        )
        return reader.options(**(options or {})).load()
    reader = reader.schema(schema)
    if rate_cap:
        reader = reader.option("maxFilesPerTrigger", rate_cap)
    return reader.options(**(options or {})).load(location)


def read_raw_stream(
    spark: SparkSession, location: str, fmt: str = "parquet", rate_cap: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw messages of a topic (``fmt='kafka'``) or of a folder of message files.

    ``rate_cap`` bounds one trigger: offsets for a topic, files for a folder.
    """
    return _read_stream(spark, fmt, location, MESSAGE, rate_cap, options)


def read_scored_stream(
    spark: SparkSession, location: str, fmt: str = "parquet", rate_cap: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages of the scored topic, as this package published them."""
    return _read_stream(spark, fmt, location, PUBLISHED, rate_cap, options)


def parse_scored(messages: DataFrame) -> DataFrame:
    """Scored messages back to their columns."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), SCORED_TXN, TIMES).alias("row")
    ).select("row.*")
