"""The history stream: scored topic to the date-partitioned history table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.config import DEFAULT_JOIN, JoinPolicy
from tillwatch.operators.joins import latest_by_key, measure
from tillwatch.operators.merge import has_key, new_rows, unkeyed_rows
from tillwatch.schemas import MESSAGE_KEY, SCORED_TXN
from tillwatch.sources.files import exists
from tillwatch.sources.messages import parse_scored
from tillwatch.sources.tables import or_empty
from tillwatch.streaming.sinks import Batch, Target, write_batch

TRIGGER = "1 minute"
MAX_DATES = 64


LAKE = T.StructType([*SCORED_TXN.fields, T.StructField("event_date", T.DateType())])


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The history table with its partition column ``event_date``; empty before the
    first write."""
    return or_empty(spark, lambda: spark.read.schema(LAKE).parquet(path), LAKE)


def candidates(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The part of the history that can hold these messages.

    A message always has the same event time, so only the folders of the batch's dates are
    opened, and nothing else of the table is listed. Offsets outside the batch's range cannot
    match, and files are written in offset order, so statistics skip most files in there. A
    batch with undated rows, or with more than ``MAX_DATES`` dates, looks through the whole
    table by offsets and range of dates.
    """
    first, last, low, high, undated = rows.agg(
        F.min("k_offset"), F.max("k_offset"), F.min("event_date"), F.max("event_date"),
        F.count_if(F.col("event_date").isNull()),
    ).first()
    in_range = F.col("k_offset").between(first, last)
    if undated:
        return read_lake(spark, path).filter(in_range)
    listed = rows.select("event_date").distinct().limit(MAX_DATES + 1).collect()
    if len(listed) > MAX_DATES:
        return read_lake(spark, path).filter(in_range & F.col("event_date").between(low, high))
    folders = [f"{path}/event_date={row[0]:%Y-%m-%d}" for row in listed]
    there = [folder for folder in folders if exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], LAKE)
    return spark.read.schema(LAKE).option("basePath", path).parquet(*there).filter(in_range)


def merge_batch(
    batch_df: DataFrame, path: str, quarantine: Target | None, batch: Batch,
    policy: JoinPolicy = DEFAULT_JOIN,
) -> None:
    """Insert the rows whose message is not in the history yet.

    Messages already there are skipped by key, so repeating a batch, in whole or after
    a partial write, adds nothing twice. Rows without a message key go to the
    quarantine target.
    """
    spark = batch_df.sparkSession
    rows = batch_df.withColumn("event_date", F.to_date("event_time"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        keyed = rows.filter(has_key())
        size = measure(keyed.select(*MESSAGE_KEY))
        if size.rows:
            known = candidates(spark, path, keyed)
            fresh = new_rows(known, keyed, small_source=size.fits(policy))
            (
                fresh.hint("rebalance", "event_date").write.mode("append")
                .partitionBy("event_date").parquet(path)
            )
        unkeyed = unkeyed_rows(rows).drop("event_date")
        if not unkeyed.isEmpty():
            if quarantine is None:
                raise ValueError("rows without message key and no quarantine target")
            write_batch(unkeyed, quarantine, batch)
    finally:
        rows.unpersist()


def merge_into_table(batch_df: DataFrame, table: str) -> None:
    """The same merge for a catalog whose tables support MERGE. The source is reduced to
    one row per message first, as MERGE would insert every copy."""
    source = latest_by_key(
        batch_df.filter(has_key()), MESSAGE_KEY,
        [F.col("ingest_time").asc(), F.col("transaction_id").asc()],
    )
    same = F.expr(" AND ".join(f"{table}.{key} = s.{key}" for key in MESSAGE_KEY))
    source.alias("s").mergeInto(table, same).whenNotMatched().insertAll().merge()


def start_lake(
    messages: DataFrame, path: str | None, checkpoint: str, quarantine: Target | None = None,
    trigger: dict | None = None, table: str | None = None,
) -> StreamingQuery:
    """Start the history writer on a stream of scored messages: into a folder of files, or
    with ``table`` by MERGE into a catalog table that supports it."""

    def on_batch(df: DataFrame, number: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if table is None:
            merge_batch(df, path, quarantine, Batch(query, number))
            return
        merge_into_table(df, table)
        unkeyed = unkeyed_rows(df)
        if quarantine is not None and not unkeyed.isEmpty():
            write_batch(unkeyed, quarantine, Batch(query, number))

    return (
        parse_scored(messages).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint}/main")
        .trigger(**(trigger or {"processingTime": TRIGGER})).start()
    )
