"""The streaming jobs as queries: the events table read as a stream of messages, run
until all available data is processed, and the written result read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.config import DEFAULT_SCORING, ScoringConfig
from tillwatch.operators.ingest import validated
from tillwatch.session import scratch_path
from tillwatch.sources import events
from tillwatch.sources.messages import parse_scored, read_raw_stream, read_scored_stream
from tillwatch.sources.tables import Refreshed
from tillwatch.streaming import hot, lake, sinks, state
from tillwatch.streaming.sinks import Batch, Target

ALL_AVAILABLE = {"availableNow": True}
# Bytes of a row group of raw messages. A task reads whole row groups, so a file of few large
# ones is read by few tasks, however many there are.
RAW_BLOCK = 8 << 20


# Where the events are cut into the micro-batches of the velocity stream.
VELOCITY_CUTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]
# The same where messages come late. Half a day between the cuts, so that of the late rows some
# still lie in a span of a day.
LATE_CUTS = ["2024-01-11 00:00:00", "2024-01-11 12:00:00"]
# Every so many events, the remainder that is late, and by how many micro-batches.
LATE = [(31, 5, 2), (7, 3, 1)]


def run_velocity(spark: SparkSession, sf_dir: str, seconds: int = 300) -> DataFrame:
    """Transactions with the velocity that the state operator gave them, over three
    micro-batches in event order. The query is started anew for each, so the state passes
    through its checkpoint."""
    raw = events.messages(events.transactions(spark, sf_dir))
    edges = [None, *map(events.at, VELOCITY_CUTS), None]
    parts = []
    for low, high in zip(edges[:-1], edges[1:]):
        part = raw if low is None else raw.filter(F.col("event_time") >= low)
        parts.append(part if high is None else part.filter(F.col("event_time") < high))
    return _run_batches(spark, parts, seconds, state.stamp_velocity)


def run_late(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    """The same where some messages come one or two micro-batches after others of their time, with
    ``arrived``, the number of the micro-batch, and ``is_late``."""
    txns = events.transactions(spark, sf_dir)
    arrived = F.lit(0)
    for cut in LATE_CUTS:
        arrived = arrived + (F.col("event_time") >= events.at(cut)).cast("int")
    number = F.col("transaction_id").cast("long")
    shift = F.lit(0)
    for every, rest, batches in reversed(LATE):
        shift = F.when(number % every == rest, batches).otherwise(shift)
    arrived = arrived + shift
    last = len(LATE_CUTS) + max(batches for _, _, batches in LATE)
    parts = [events.messages(txns.filter(arrived == n)) for n in range(last + 1)]
    rows = _run_batches(spark, parts, seconds, state.stamp_lateness)
    return rows.withColumn("arrived", F.substring_index("batch", "-", -1).cast("int"))


def _run_batches(
    spark: SparkSession, parts: list[DataFrame], seconds: int, stamp: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What the velocity stream writes when ``parts`` arrive as one micro-batch each."""
    root = scratch_path(spark, "velocity")
    out = Target(f"{root}/out")
    numbers = iter(range(1_000_000))

    def on_batch(df: DataFrame, _: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sinks.write_batch(stamp(df), out, Batch("velocity", next(numbers)))
        finally:
            df.unpersist()

    for part in parts:
        writer = part.drop("event_time").write.mode("append").option("parquet.block.size", RAW_BLOCK)
        writer.parquet(f"{root}/raw")
        good, _ = validated(read_raw_stream(spark, f"{root}/raw"))
        writer = state.velocity_stateful(good.drop("raw_json"), seconds).writeStream.foreachBatch(on_batch)
        writer = writer.option("checkpointLocation", f"{root}/checkpoint")
        hot.start_stateful(writer, spark, ALL_AVAILABLE).awaitTermination()
    return spark.read.parquet(out.location)


def run_hot(
    spark: SparkSession, sf_dir: str, cfg: ScoringConfig = DEFAULT_SCORING
) -> hot.HotTargets:
    """Score the whole stream into fresh targets."""
    root = scratch_path(spark, "hot")
    txns = events.transactions(spark, sf_dir)
    names = ["transactions", "fraud_scores", "locations", "alerts", "clean", "scored", "ledger"]
    targets = hot.HotTargets(**{name: Target(f"{root}/{name}") for name in names})
    ctx = hot.HotContext(
        targets, Refreshed(lambda: events.customers(txns)), Refreshed(lambda: events.risk(txns)), cfg
    )
    messages = events.message_stream(spark, sf_dir)
    # The derived transactions arrive two seconds after their event.
    arrival = F.try_to_timestamp(F.col("j.timestamp")) + F.expr("INTERVAL 2 SECONDS")
    hot.start_hot(
        messages, ctx, f"{root}/checkpoint", ALL_AVAILABLE, ingest_time=arrival).awaitTermination()
    return targets


def read_scored(spark: SparkSession, targets: hot.HotTargets) -> DataFrame:
    return parse_scored(spark.read.parquet(targets.scored.location))


def run_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the stream."""
    root = scratch_path(spark, "dlq")
    target = Target(f"{root}/dlq")
    messages = events.message_stream(spark, sf_dir, corrupt=True)
    hot.start_dlq(messages, target, f"{root}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return spark.read.schema("value string").parquet(target.location)


def run_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the stream, then write its scored topic to a history table."""
    targets = run_hot(spark, sf_dir)
    root = scratch_path(spark, "lake")
    scored = read_scored_stream(spark, targets.scored.location)
    lake.start_lake(
        scored, f"{root}/table", f"{root}/checkpoint", trigger=ALL_AVAILABLE
    ).awaitTermination()
    return lake.read_lake(spark, f"{root}/table")


def run_folded(
    spark: SparkSession, rows: DataFrame, again: DataFrame, key: str, arrival: str, schema
) -> Target:
    """A keyed serving folder after four batches (three by arrival, then ``again``) with folds
    between them, so that it is part base and part batch folders."""
    target = Target(scratch_path(spark, "folded"))
    cuts = [None, *map(events.at, VELOCITY_CUTS), None]
    for number in range(len(cuts)):
        if number < len(cuts) - 1:
            low, high = cuts[number], cuts[number + 1]
            part = rows if low is None else rows.filter(F.col(arrival) >= low)
            part = part if high is None else part.filter(F.col(arrival) < high)
        else:
            part = again
        dated = part.withColumn("arrival_date", F.to_date(arrival))
        sinks.write_batch(dated, target, Batch("folded", number), "arrival_date")
        if number in (1, 2):
            sinks.fold(spark, target, [key], arrival, schema)
    return target
