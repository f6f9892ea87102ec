"""Messages to validated transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.schemas import RAW_TXN

_CORRUPT = "_corrupt"

# The reasons of rejected messages, in the order in which they are tried. The
# last two are additions: amounts that no money column holds, and events from the future.
REASONS = [
    "schema_parse_error", "missing_transaction_id", "missing_user_id", "missing_amount",
    "non_positive_amount", "missing_merchant_id", "bad_timestamp",
    "amount_out_of_range", "future_timestamp",
]
# The least amount beyond DECIMAL(18,2).
AMOUNT_LIMIT = 1e16


def project_meta(messages: DataFrame) -> DataFrame:
    """Broker columns to typed identity columns plus the message text."""
    return messages.select(
        F.col("topic").cast("string").alias("k_topic"),
        F.col("partition").cast("int").alias("k_partition"),
        F.col("offset").cast("long").alias("k_offset"),
        F.col("value").cast("string").alias("raw_json"),
    )


def parse_raw(messages: DataFrame, strict_parse: bool = False) -> DataFrame:
    """Add the parsed struct ``j``. Unreadable text gives a struct of NULLs; with
    ``strict_parse`` that text is also kept in ``_corrupt`` so it can be told apart.

    The struct passes through an array of one. Filters on its fields stop there instead
    of being pushed into the parse, which would then run once per field they mention.
    """
    schema, options = RAW_TXN, {}
    if strict_parse:
        schema = T.StructType([*RAW_TXN.fields, T.StructField(_CORRUPT, T.StringType())])
        options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json("raw_json", schema, options)
    return messages.select("*", F.explode(F.array(parsed)).alias("j"))


def expand_txn(parsed: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Flatten the struct, parse the event time and stamp the arrival time."""
    fields = [f"j.{name}" for name in RAW_TXN.fieldNames() if name != "timestamp"]
    return parsed.select(
        "*",
        *fields,
        F.try_to_timestamp(F.col("j.timestamp")).alias("event_time"),
        (F.current_timestamp() if ingest_time is None else ingest_time).alias("ingest_time"),
    )


def _missing(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def tag_dlq(
    expanded: DataFrame, strict_parse: bool = False, max_future_skew: str | None = None
) -> DataFrame:
    """Add ``dlq_reason``: the first rule a row breaks, NULL for a good row.

    ``max_future_skew`` (an interval such as ``'1 hour'``) also rejects events dated
    further ahead of their arrival; it is off unless given.
    """
    unreadable = F.col("j").isNull()
    if strict_parse:
        unreadable = unreadable | F.col(f"j.{_CORRUPT}").isNotNull()
    broken = [
        unreadable,
        _missing("transaction_id"),
        _missing("user_id"),
        F.col("amount").isNull(),
        F.col("amount") <= 0,
        _missing("merchant_id"),
        F.col("event_time").isNull(),
        F.isnan("amount") | (F.col("amount") >= AMOUNT_LIMIT),
    ]
    if max_future_skew:
        limit = F.col("ingest_time") + F.expr(f"INTERVAL {max_future_skew}")
        broken.append(F.col("event_time") > limit)
    reason = F.when(broken[0], F.lit(REASONS[0]))
    for rule, name in zip(broken[1:], REASONS[1:]):
        reason = reason.when(rule, F.lit(name))
    return expanded.withColumn("dlq_reason", reason)


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): every tagged row is in exactly one of them."""
    good = tagged.filter(F.col("dlq_reason").isNull()).drop("dlq_reason", "j")
    return good, tagged.filter(F.col("dlq_reason").isNotNull())


def validated(
    messages: DataFrame, ingest_time: Column | None = None, strict_parse: bool = False,
    max_future_skew: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Broker messages to (good transactions, rejected messages)."""
    parsed = parse_raw(project_meta(messages), strict_parse)
    return split(tag_dlq(expand_txn(parsed, ingest_time), strict_parse, max_future_skew))


def normalize_ingest(requests: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Turn submitted transactions into raw messages: (accepted, rejected).

    A request needs a user, a merchant and a positive amount. Accepted rows get an id,
    the default status and a UTC time stamp, and become the JSON text of the raw topic.
    """
    now = F.current_timestamp() if now is None else now
    valid = (
        F.col("user_id").isNotNull() & F.col("merchant_id").isNotNull()
        & F.coalesce(F.col("amount") > 0, F.lit(False))
    )
    accepted = requests.filter(valid).select(
        F.uuid().alias("transaction_id"),
        "user_id", "amount", "merchant_id", "merchant_lat", "merchant_lon",
        F.coalesce("status", F.lit("pending")).alias("status"),
        F.date_format(
            F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
        ).alias("timestamp"),
    )
    messages = accepted.select(
        "transaction_id",
        F.to_json(F.struct(*RAW_TXN.fieldNames()), {"ignoreNullFields": "false"}).alias("value"),
    )
    return messages, requests.filter(~valid)
