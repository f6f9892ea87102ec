"""Sinks of the streaming jobs.

Every write is idempotent per micro-batch: a file target keeps one folder per batch and
a repeated batch replaces its own folder. A failing sink raises, so the batch is tried
again from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.joins import latest_by_key
from tillwatch.schemas import SERVING_FRAUD_SCORES, SERVING_TRANSACTIONS
from tillwatch.streaming import keyed

# How far before its own time a row may arrive.
MAX_SKEW = "1 DAY"


@dataclass(frozen=True)
class Target:
    """Where a sink writes: a folder, a topic (``fmt='kafka'``) or a connector table."""

    location: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_files(self) -> bool:
        return self.fmt in ("parquet", "orc", "json")


@dataclass(frozen=True)
class Batch:
    """Identity of a micro-batch: the query (as its checkpoint names it) and number."""

    query: str
    number: int

    @property
    def folder(self) -> str:
        return f"batch={self.query}-{self.number:012d}"


def write_batch(
    df: DataFrame, target: Target, batch: Batch, partition_by: str | None = None
) -> None:
    """Write one micro-batch. Connector targets append, keyed tables there upsert."""
    if not target.is_files:
        writer = df.write.format(target.fmt).options(**target.options).mode("append")
        if target.fmt == "kafka":
            writer.option("topic", target.location).save()
        else:
            writer.save(target.location)
        return
    if partition_by:
        # Adaptive execution sizes the output: small dates share a task, a date that
        # holds most of the rows is cut into several.
        df = df.hint("rebalance", partition_by)
    writer = df.write.format(target.fmt).options(**target.options).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(f"{target.location}/{batch.folder}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a serving table in their types; money becomes DECIMAL(18,2) here. A
    value that its type cannot hold becomes NULL and stops nothing; validation has rejected
    such amounts before."""
    return df.select(*[F.col(f.name).try_cast(_stored(f.dataType)).alias(f.name) for f in schema])


def _stored(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, T.VarcharType) else kind


def serving_transactions(scored: DataFrame) -> DataFrame:
    """All scored rows with the columns of the serving table."""
    return scored.select(*SERVING_TRANSACTIONS.fieldNames())


def serving_fraud_scores(scored: DataFrame) -> DataFrame:
    """Flagged rows as alerts that nobody has reviewed yet."""
    return scored.filter("is_flagged").withColumns({
        "flagged_at": F.col("ingest_time"), "reviewed": F.lit(None).cast("boolean"),
    }).select(*SERVING_FRAUD_SCORES.fieldNames())


def fold(
    spark: SparkSession, target: Target, keys: list[str], arrival: str, schema: T.StructType,
    buckets: int = keyed.BUCKETS, ended: bool = False,
) -> int:
    """Fold the closed batches of a file-based serving table into its base."""
    return keyed.fold(spark, target.location, keys, arrival, _declared(schema), target.fmt,
                      dict(target.options), buckets, ended)


def read_current(
    spark: SparkSession, target: Target, keys: list[str], arrival: str, schema: T.StructType | None = None,
) -> DataFrame:
    """A file-based serving table with the newest row of each key."""
    return _newest(_stored_rows(spark, target, schema), keys, arrival)


def read_arrived(
    spark: SparkSession, target: Target, keys: list[str], arrival: str, since: Column,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The newest row of each key among what arrived at or after ``since``, whatever its event
    time. Only the folders of those days are listed."""
    rows = _stored_rows(spark, target, schema, _day(spark, since))
    recent = rows.filter((F.col(arrival) >= since) & (F.col("arrival_date") >= F.to_date(since)))
    return _newest(recent, keys, arrival)


def read_window(
    spark: SparkSession, target: Target, keys: list[str], time: str, arrival: str, since: Column,
    schema: T.StructType | None = None, skew: str = MAX_SKEW,
) -> DataFrame:
    """Current rows with ``time`` at or after ``since``, without reading the history.

    A newer version of a row that lies in the window arrived after that row. So the
    earliest arrival among the window's rows bounds the versions that can matter, and only
    those are reduced to one row per key. No row arrives more than ``skew`` before its own
    time (validation rejects such events), which bounds the days that are looked through.
    """
    first_day = since - F.expr(f"INTERVAL {skew}")
    rows = _stored_rows(spark, target, schema, _day(spark, first_day))
    in_window = F.col(time) >= since
    on_days = F.col("arrival_date") >= F.to_date(first_day)
    first = rows.filter(in_window & on_days).agg(F.min(arrival)).first()[0]
    if first is None:
        later = rows.filter(F.lit(False))
    else:
        later = rows.filter((F.col(arrival) >= first) & (F.col("arrival_date") >= F.to_date(F.lit(first))))
    return _newest(later, keys, arrival).filter(in_window)


def read_newest(
    spark: SparkSession, target: Target, keys: list[str], arrival: str, n: int,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Current rows among which are the ``n`` that arrived last.

    Days are walked backwards until those looked at hold ``n`` keys. A key that occurs on older
    days only arrived before all of them, so no older day can change the list. The number of
    days doubles with each step: at most twice the needed days are read.
    """
    days, take = keyed.days(spark, target.location), 1
    while True:
        since = days[min(take, len(days)) - 1] if days else None
        rows = _stored_rows(spark, target, schema, since)
        if since is not None:
            rows = rows.filter(F.col("arrival_date") >= F.lit(since))
        if take >= len(days) or rows.select(*keys).distinct().limit(n).count() == n:
            return _newest(rows, keys, arrival)
        take *= 2


def _newest(rows: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    return latest_by_key(rows, keys, keyed.newest_first(arrival)).drop("batch", "arrival_date")


def _day(spark: SparkSession, time: Column) -> date:
    return spark.range(1).select(F.to_date(time)).first()[0]


def _declared(schema: T.StructType) -> T.StructType:
    return T.StructType([
        *[T.StructField(f.name, _stored(f.dataType)) for f in schema],
        T.StructField("batch", T.StringType()), T.StructField("arrival_date", T.DateType()),
    ])


def _stored_rows(
    spark: SparkSession, target: Target, schema: T.StructType | None, since: date | None = None
) -> DataFrame:
    if schema is None:
        declared = spark.read.format(target.fmt).options(**target.options).load(target.location).schema
    else:
        declared = _declared(schema)
    return keyed.stored(spark, target.location, declared, since, target.fmt, dict(target.options))
