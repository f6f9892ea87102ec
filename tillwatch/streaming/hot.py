"""The scoring stream: raw topic to serving tables and topics, and its dead letters."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillwatch.config import DEFAULT_JOIN, DEFAULT_SCORING, JoinPolicy, ScoringConfig
from tillwatch.functions import payloads
from tillwatch.operators.enrich import user_features
from tillwatch.operators.ingest import validated
from tillwatch.operators.joins import Size, left_join_unique, measure
from tillwatch.operators.profiles import last_locations
from tillwatch.operators.scoring import score_enriched
from tillwatch.operators.stats import batch_stats
from tillwatch.schemas import LEDGER, SERVING_FRAUD_SCORES, SERVING_TRANSACTIONS
from tillwatch.session import SETTINGS, settings
from tillwatch.sources.tables import Refreshed, is_gone
from tillwatch.streaming.sinks import (
    Batch, Target, conform, serving_fraud_scores, serving_transactions, write_batch,
)
from tillwatch.streaming.state import batch_rows, batch_users, velocity_stateful

log = logging.getLogger(__name__)

TRIGGER = "10 seconds"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class HotTargets:
    transactions: Target
    fraud_scores: Target
    locations: Target
    alerts: Target
    clean: Target
    scored: Target
    ledger: Target


@dataclass(frozen=True)
class HotContext:
    """What a micro-batch needs besides its rows."""

    targets: HotTargets
    customers: Refreshed
    risk: Refreshed
    scoring: ScoringConfig = field(default=DEFAULT_SCORING)
    policy: JoinPolicy = field(default=DEFAULT_JOIN)


def score_batch(tagged: DataFrame, ctx: HotContext, size: Size) -> DataFrame:
    """Score one micro-batch. Velocity, customer and location are gathered for the users
    of the batch only (``size`` of them), so the rows are joined once."""
    users = batch_users(tagged)
    if size.fits(ctx.policy):
        keys = users.select("user_id")
        customers, risk = ctx.customers.for_users(keys), ctx.risk.for_users(keys)
    else:
        customers, risk = ctx.customers.get(), ctx.risk.get()
    features = user_features(users, customers, risk)
    return score_enriched(
        left_join_unique(batch_rows(tagged), features, ["user_id"], ctx.policy, size), ctx.scoring
    )


def process_batch(tagged: DataFrame, batch: Batch, ctx: HotContext) -> dict[str, int] | None:
    """Score a micro-batch and write every sink, the ledger row last.

    A batch that is already in the ledger was written completely and is skipped. Spark
    turns adaptive execution off for queries with state; the joins and writes here count
    on it, and the state operator has already been planned.
    """
    spark = tagged.sparkSession
    if in_ledger(spark, ctx.targets.ledger, batch):
        return None
    with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
        try:
            return _score_and_write(tagged, batch, ctx)
        except Exception as error:
            if not is_gone(error):
                raise
            # A dimension was replaced twice since it was read. Every write of the batch may
            # be repeated, so it is scored again with what the tables hold now.
            log.warning("a dimension's files are gone, scoring the batch again")
            ctx.customers.forget()
            ctx.risk.forget()
            return _score_and_write(tagged, batch, ctx)


def _score_and_write(tagged: DataFrame, batch: Batch, ctx: HotContext) -> dict[str, int] | None:
    spark, to = tagged.sparkSession, ctx.targets
    # Persisted before its first action, so the stateful plan runs once.
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    scored = None
    try:
        users = measure(batch_users(tagged))
        if users.rows == 0:
            return None
        # Seven more columns join the user id: plan, location, times and averages.
        size = Size(users.rows, users.bytes + 7 * 16 * users.rows)
        scored = score_batch(tagged, ctx, size).persist(StorageLevel.MEMORY_AND_DISK)
        totals = batch_stats(scored).first().asDict()

        transactions = conform(serving_transactions(scored), SERVING_TRANSACTIONS)
        dated = transactions.withColumn("arrival_date", F.to_date("ingest_time"))
        write_batch(dated, to.transactions, batch, "arrival_date")
        alerts = conform(serving_fraud_scores(scored), SERVING_FRAUD_SCORES)
        dated = alerts.withColumn("arrival_date", F.to_date("flagged_at"))
        write_batch(dated, to.fraud_scores, batch, "arrival_date")
        write_batch(last_locations(scored), to.locations, batch)
        write_batch(payloads.alerts_payload(scored), to.alerts, batch)
        write_batch(payloads.clean_payload(scored), to.clean, batch)
        write_batch(payloads.scored_payload(scored), to.scored, batch)
        write_batch(_ledger_row(spark, batch, totals), to.ledger, batch)
        log.info(json.dumps({"batch_id": batch.number, **totals}))
        return totals
    finally:
        if scored is not None:
            scored.unpersist()
        tagged.unpersist()


def _ledger_row(spark: SparkSession, batch: Batch, totals: dict[str, int]) -> DataFrame:
    return spark.range(1).select(
        F.lit(batch.query).alias("query_id"),
        F.lit(batch.number).cast("long").alias("batch_id"),
        F.current_timestamp().alias("processed_at"),
        *[F.lit(value).cast("long").alias(name) for name, value in totals.items()],
    )


def in_ledger(spark: SparkSession, ledger: Target, batch: Batch) -> bool:
    """Whether the ledger holds the row of a batch, so all its sinks are written."""
    if not ledger.is_files:
        return False
    try:
        rows = spark.read.format(ledger.fmt).schema(LEDGER)
        return not rows.load(f"{ledger.location}/{batch.folder}").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def start_hot(
    messages: DataFrame, ctx: HotContext, checkpoint: str, trigger: dict | None = None,
    strict_parse: bool = False, max_future_skew: str | None = None,
    ingest_time: Column | None = None,
) -> StreamingQuery:
    """Start the scoring query on a stream of broker messages. ``ingest_time`` replaces the
    clock as the time of arrival, for replays that have to repeat exactly."""
    good, _ = validated(messages, ingest_time, strict_parse, max_future_skew)
    good = good.drop("raw_json")
    tagged = velocity_stateful(good, ctx.scoring.velocity_seconds, ctx.scoring.idle_ms)

    def on_batch(df: DataFrame, number: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(df, Batch(query, number), ctx)

    return start_stateful(
        tagged.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint}/main"),
        tagged.sparkSession, trigger or {"processingTime": TRIGGER},
    )


def start_stateful(writer: DataStreamWriter, spark: SparkSession, trigger: dict) -> StreamingQuery:
    """Start a query with idle timeouts, on the store that keyed maps and timers need. A run
    over the available data would go on with empty batches to time out the state, so it runs
    without those and ends."""
    values = {STATE_STORE: SETTINGS[STATE_STORE]}
    if trigger.get("availableNow"):
        values["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    with settings(spark, values):
        return writer.trigger(**trigger).start()


def start_dlq(
    messages: DataFrame, target: Target, checkpoint: str, trigger: dict | None = None,
    strict_parse: bool = False, max_future_skew: str | None = None,
) -> StreamingQuery:
    """Start the dead-letter query: its own reader and checkpoint, exactly once for
    files by the log of Spark's file sink."""
    _, bad = validated(messages, None, strict_parse, max_future_skew)
    writer = (
        payloads.dlq_payload(bad).writeStream.format(target.fmt).options(**target.options)
        .option("checkpointLocation", f"{checkpoint}/dlq")
        .trigger(**(trigger or {"processingTime": TRIGGER}))
    )
    if target.fmt == "kafka":
        return writer.option("topic", target.location).start()
    return writer.option("path", target.location).start()


def supervise(spark: SparkSession) -> None:
    """Wait until any query ends; raises its error. The others are stopped, so that the
    job restarts as a whole."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()
