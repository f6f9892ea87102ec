"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame.

Times are shown as text and derived doubles are rounded, so that two engines agree on
the result; the operators themselves do neither.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.config import DEFAULT_SCORING, ScoringConfig
from tillwatch.functions import geo, payloads, rules
from tillwatch.operators import (
    enrich, ingest, merge, profiles, quality, scoring, serving, stats, velocity,
)
from tillwatch.operators.joins import latest_by_key, left_join_unique
from tillwatch.plans import loads, streams
from tillwatch.schemas import MESSAGE_KEY, SERVING_FRAUD_SCORES, SERVING_TRANSACTIONS
from tillwatch.sources import events
from tillwatch.sources.events import AS_OF, AS_OF_HOUR, at
from tillwatch.sources.messages import parse_scored
from tillwatch.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DAY_SECONDS = 86_400
DAY_SCORING = ScoringConfig(velocity_seconds=DAY_SECONDS)


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def shown(df: DataFrame) -> DataFrame:
    """Timestamps as text with microseconds, dates as text, doubles to six decimals."""
    texts = {
        "timestamp": "date_format({0}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {0}",
        "date": "date_format({0}, 'yyyy-MM-dd') AS {0}",
        "double": "round({0}, 6) AS {0}",
    }
    return df.selectExpr(*[texts.get(kind, "{0}").format(name) for name, kind in df.dtypes])


def txns(spark: SparkSession, sf: str) -> DataFrame:
    return events.transactions(spark, sf)


def scored(spark: SparkSession, sf: str, cfg: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    txn = txns(spark, sf)
    return scoring.score_transactions(txn, events.customers(txn), events.risk(txn), cfg)


def located(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    return enrich.enrich_risk(txn, events.risk(txn))


def priced(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    return scoring.with_zscore(
        enrich.fill_defaults(enrich.enrich_customers(txn, events.customers(txn)))
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.serving_fraud_scores(scored(spark, sf))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    messages = events.messages(txns(spark, sf), corrupt=True)
    parsed = ingest.parse_raw(ingest.project_meta(messages))
    return ingest.tag_dlq(ingest.expand_txn(parsed, at(AS_OF)))


def built_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.risk_profiles(txns(spark, sf), at(AS_OF))


# Messages ------------------------------------------------------------------------


@query("project_kafka_meta")
def project_kafka_meta(spark: SparkSession, sf: str) -> DataFrame:
    meta = ingest.project_meta(events.messages(txns(spark, sf)))
    return meta.select(
        "k_topic", "k_partition", "k_offset",
        F.get_json_object("raw_json", "$.transaction_id").alias("transaction_id"),
    )


@query("expand_txn")
def expand_txn(spark: SparkSession, sf: str) -> DataFrame:
    parsed = ingest.parse_raw(ingest.project_meta(events.messages(txns(spark, sf))))
    return shown(ingest.expand_txn(parsed, at(AS_OF)).drop("j", "raw_json"))


@query("validate_dlq_reason")
def validate_dlq_reason(spark: SparkSession, sf: str) -> DataFrame:
    return tagged(spark, sf).select(
        "k_topic", "k_partition", "k_offset", F.coalesce("dlq_reason", F.lit("ok")).alias("reason")
    )


@query("split_good_bad")
def split_good_bad(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = ingest.split(tagged(spark, sf))
    sides = good.select(F.lit("good").alias("side"), "k_partition").unionByName(
        bad.select(F.lit("bad").alias("side"), "k_partition")
    )
    return sides.groupBy("side", "k_partition").agg(F.count(F.lit(1)).alias("n"))


@query("emit_dlq")
def emit_dlq(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = ingest.split(tagged(spark, sf))
    return _dead_letters(payloads.dlq_payload(bad))


def _dead_letters(values: DataFrame) -> DataFrame:
    names = ["reason", "topic", "partition", "offset", "ingest_time", "raw_json"]
    return values.select(F.json_tuple("value", *names).alias(*names)).select(
        "reason", "topic", F.col("partition").cast("long"), F.col("offset").cast("long"),
        "ingest_time", *_raw_fields("raw_json"),
    )


RAW_TEXTS = ["transaction_id", "user_id", "merchant_id", "status", "timestamp"]


def _raw_fields(text: str) -> list[Column]:
    """The fields of a rejected message's text, and the text itself where it has none."""
    status = F.get_json_object(text, "$.status")
    return [
        *[F.get_json_object(text, f"$.{name}").alias(f"raw_{name}") for name in RAW_TEXTS],
        F.get_json_object(text, "$.amount").cast("double").alias("raw_amount"),
        F.when(status.isNull(), F.col(text)).alias("raw_text"),
    ]


@query("ingest_normalize")
def ingest_normalize(spark: SparkSession, sf: str) -> DataFrame:
    requests = txns(spark, sf).withColumns({
        "amount": F.col("amount") - 1.0,
        "status": F.when(F.col("status") != "view", F.col("status")),
    })
    accepted, rejected = ingest.normalize_ingest(requests, at(AS_OF))
    numbers = ["amount", "merchant_lat", "merchant_lon"]
    names = ["user_id", "merchant_id", "status", "timestamp", *numbers]
    fields = accepted.select(
        F.lit("accepted").alias("side"), F.length("transaction_id").alias("id_length"),
        F.json_tuple("value", *names).alias(*names)
    ).withColumns({name: F.col(name).cast("double") for name in numbers})
    refused = rejected.select(
        F.lit("rejected").alias("side"), F.lit(0).alias("id_length"), *[n for n in names if n != "timestamp"]
    )
    return shown(fields.unionByName(refused, allowMissingColumns=True))


# Enrichment ----------------------------------------------------------------------


@query("load_customers_dim")
def load_customers_dim(spark: SparkSession, sf: str) -> DataFrame:
    return shown(enrich.customer_dim(events.customers(txns(spark, sf))))


@query("load_risk_profiles")
def load_risk_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return shown(enrich.risk_dim(events.risk(txns(spark, sf))))


@query("enrich_customers")
def enrich_customers(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    joined = enrich.enrich_customers(txn, events.customers(txn))
    return shown(joined.select("transaction_id", "user_id", "amount", "plan", "avg_amount_30d"))


@query("enrich_risk")
def enrich_risk(spark: SparkSession, sf: str) -> DataFrame:
    return shown(located(spark, sf).select(
        "transaction_id", "user_id", "last_merchant_lat", "last_merchant_lon", "updated_at"
    ))


@query("fill_enrichment_defaults")
def fill_enrichment_defaults(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    joined = enrich.enrich_customers(txn, events.customers(txn))
    return shown(
        enrich.fill_defaults(joined).select("transaction_id", "plan", "avg_amount_30d")
    )


# Features and rules --------------------------------------------------------------


def _velocity(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "user_id", "velocity_5min")


@query("velocity_trailing")
def velocity_trailing(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(velocity.velocity_trailing(txns(spark, sf)))


@query("velocity_trailing_24h")
def velocity_trailing_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(velocity.velocity_trailing(txns(spark, sf), DAY_SECONDS))


@query("velocity_snapshot")
def velocity_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(velocity.velocity_snapshot(txns(spark, sf)))


@query("velocity_snapshot_24h")
def velocity_snapshot_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(velocity.velocity_snapshot(txns(spark, sf), DAY_SECONDS))


@query("haversine_km")
def haversine_km(spark: SparkSession, sf: str) -> DataFrame:
    distance = geo.haversine_km(
        F.col("last_merchant_lat"), F.col("last_merchant_lon"),
        F.col("merchant_lat"), F.col("merchant_lon"),
    )
    return located(spark, sf).select("transaction_id", F.round(distance, 6).alias("km"))


@query("geo_speed_kmh")
def geo_speed_kmh(spark: SparkSession, sf: str) -> DataFrame:
    speeds = scoring.with_geo_speed(located(spark, sf))
    return speeds.select("transaction_id", F.round("geo_speed_kmh", 3).alias("geo_speed_kmh"))


@query("amount_zscore")
def amount_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return shown(priced(spark, sf).select("transaction_id", "amount_zscore"))


@query("score_velocity")
def score_velocity(spark: SparkSession, sf: str) -> DataFrame:
    trailing = velocity.velocity_trailing(txns(spark, sf), DAY_SECONDS)
    return trailing.select(
        "transaction_id", rules.score_velocity(F.col("velocity_5min")).alias("score_velocity")
    )


@query("score_zscore")
def score_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).select(
        "transaction_id", rules.score_zscore(F.col("amount_zscore")).alias("score_zscore")
    )


@query("score_geo")
def score_geo(spark: SparkSession, sf: str) -> DataFrame:
    speeds = scoring.with_geo_speed(located(spark, sf))
    return speeds.select(
        "transaction_id", rules.score_geo(F.col("geo_speed_kmh")).alias("score_geo")
    )


@query("fraud_score")
def fraud_score(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(
        "transaction_id", "score_velocity", "score_zscore", "score_geo", "fraud_score"
    )


@query("fraud_score_24h")
def fraud_score_24h(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf, DAY_SCORING).select(
        "transaction_id", "velocity_5min", "fraud_score", "is_flagged", "reasons"
    )


@query("is_flagged")
def is_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("transaction_id", "fraud_score", "is_flagged")


@query("reasons")
def reasons(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("transaction_id", "reasons")


@query("flagged_only")
def flagged_only(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.flagged(scored(spark, sf)).select(
        "transaction_id", "user_id", "fraud_score", "reasons"
    )


# Sinks and payloads --------------------------------------------------------------


@query("sink_transactions")
def sink_transactions(spark: SparkSession, sf: str) -> DataFrame:
    rows = sinks.serving_transactions(scored(spark, sf))
    return shown(rows.withColumn("geo_speed_kmh", F.round("geo_speed_kmh", 3)))


@query("sink_fraud_scores")
def sink_fraud_scores(spark: SparkSession, sf: str) -> DataFrame:
    return shown(alerts(spark, sf))


@query("sink_last_location")
def sink_last_location(spark: SparkSession, sf: str) -> DataFrame:
    return shown(profiles.last_locations(txns(spark, sf)))


@query("merge_profiles")
def merge_profiles(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    daily = profiles.risk_profiles(
        txn.filter(F.col("event_time") < at(events.RISK_CUTOFF)), at(events.RISK_CUTOFF)
    )
    late = txn.filter(F.col("event_time") >= at(events.RISK_CUTOFF))
    return shown(profiles.merge_profiles(daily, profiles.last_locations(late)))


def _fields(messages: DataFrame, texts: list[str], numbers: list[str]) -> DataFrame:
    columns = messages.select("key", F.json_tuple("value", *texts, *numbers).alias(*texts, *numbers))
    return columns.withColumns({name: F.col(name).cast("double") for name in numbers})


@query("emit_alerts")
def emit_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _fields(
        payloads.alerts_payload(scored(spark, sf)),
        ["transaction_id", "user_id", "reasons", "flagged_at"], ["amount", "fraud_score"],
    )


@query("emit_clean")
def emit_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _fields(
        payloads.clean_payload(scored(spark, sf)),
        ["transaction_id", "user_id", "merchant_id", "status", "plan", "is_flagged", "event_time"],
        ["amount", "fraud_score"],
    )


@query("emit_scored")
def emit_scored(spark: SparkSession, sf: str) -> DataFrame:
    return _fields(
        payloads.scored_payload(scored(spark, sf)),
        ["transaction_id", "user_id", "merchant_id", "status", "reasons", "is_flagged", "k_topic",
         "event_time", "ingest_time"],
        ["amount", "merchant_lat", "merchant_lon", "fraud_score", "k_partition", "k_offset"],
    )


@query("parse_scored")
def parse_scored_query(spark: SparkSession, sf: str) -> DataFrame:
    return shown(parse_scored(payloads.scored_payload(scored(spark, sf))))


# Keyed tables --------------------------------------------------------------------

BUILT = "2024-01-29 12:00:00"
CHANGED_FROM = "2024-01-20 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"
BATCH_COLUMNS = ["transaction_id", "user_id", "amount", "ingest_time", *MESSAGE_KEY]


@query("latest_per_user")
def latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    newest = profiles.latest_per_user(txns(spark, sf))
    return shown(newest.select("user_id", "transaction_id", "amount", "event_time"))


@query("latest_by_key")
def latest_by_key_query(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that changes the status of recent transactions, upserted by id."""
    stored = txns(spark, sf).select(
        "transaction_id", "user_id", "status", "event_time", F.lit(0).cast("long").alias("batch_id")
    )
    batch = stored.filter(F.col("event_time") >= at(CHANGED_FROM)).withColumns({
        "status": F.concat(F.lit("final_"), "status"), "batch_id": F.lit(1).cast("long"),
    })
    return shown(merge.upsert(stored, batch, ["transaction_id"], ["batch_id"]))


def _lake_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """History up to the 20th, and a batch from the 15th on with every message twice;
    the second copy arrives an hour later."""
    rows = txns(spark, sf).select(*BATCH_COLUMNS, "event_time")
    lake = rows.filter(F.col("event_time") < at(CHANGED_FROM)).drop("event_time")
    once = rows.filter(F.col("event_time") >= at(BATCH_FROM)).drop("event_time")
    copies = once.withColumn(
        "ingest_time",
        F.explode(F.array("ingest_time", F.col("ingest_time") + F.expr("INTERVAL 1 HOUR"))),
    )
    return lake, copies


@query("merge_anti")
def merge_anti(spark: SparkSession, sf: str) -> DataFrame:
    lake, batch = _lake_and_batch(spark, sf)
    return shown(merge.new_rows(lake, batch))


@query("lake_merge_insert")
def lake_merge_insert(spark: SparkSession, sf: str) -> DataFrame:
    lake, batch = _lake_and_batch(spark, sf)
    return shown(merge.merge_insert(lake, batch))


# Aggregates and dashboard --------------------------------------------------------


@query("batch_stats")
def batch_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.batch_stats(scored(spark, sf))


@query("running_totals")
def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The hours of the data as batches."""
    hour = F.expr("unix_seconds(event_time) div 3600").alias("batch_id")
    ledger = scored(spark, sf).groupBy(hour).agg(*stats.batch_counters())
    return stats.running_totals(ledger)


@query("running_totals_in_blocks")
def running_totals_in_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Two queries (even and odd users) over the minutes of the data, in blocks of a day."""
    ledger = scored(spark, sf).groupBy(
        F.expr("if(cast(substring_index(user_id, '_', -1) as bigint) % 2 = 0, 'even', 'odd')").alias("query_id"),
        F.expr("unix_seconds(event_time) div 60").alias("batch_id")).agg(*stats.batch_counters())
    return stats.running_totals_in_blocks(ledger, 1440)


@query("recent_window_filter")
def recent_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = serving.recent(txns(spark, sf), "event_time", "24 HOURS", at(AS_OF_HOUR))
    return shown(rows.select("transaction_id", "user_id", "event_time"))


@query("dashboard_stats")
def dashboard_stats(spark: SparkSession, sf: str) -> DataFrame:
    return shown(serving.dashboard_stats(scored(spark, sf), at(AS_OF_HOUR)))


@query("flag_rate")
def flag_rate(spark: SparkSession, sf: str) -> DataFrame:
    day = serving.dashboard_stats(scored(spark, sf, DAY_SCORING), at("2024-01-21 00:30:00"))
    return serving.with_flag_rate(day).select("total_transactions", "flagged_count", "flag_rate")


@query("stat_cards")
def stat_cards(spark: SparkSession, sf: str) -> DataFrame:
    return serving.stat_cards(serving.dashboard_stats(scored(spark, sf), at(AS_OF_HOUR)))


@query("top_risky_users")
def top_risky_users(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_risky_users(alerts(spark, sf), at("2024-01-21 00:00:00"))


@query("recent_fraud_scores")
def recent_fraud_scores(spark: SparkSession, sf: str) -> DataFrame:
    return shown(serving.recent_fraud_scores(alerts(spark, sf)))


@query("scores_timeline")
def scores_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return serving.scores_timeline(serving.recent_fraud_scores(alerts(spark, sf)))


@query("presentation_columns")
def presentation_columns(spark: SparkSession, sf: str) -> DataFrame:
    return serving.present_alerts(alerts(spark, sf)).select(
        "transaction_id", "short_id", "display_time", "chart_time"
    )


@query("score_band")
def score_band(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf, DAY_SCORING).select(
        "transaction_id", "fraud_score", rules.score_band(F.col("fraud_score")).alias("band")
    )


# Profiles and checks -------------------------------------------------------------


@query("risk_profile_features")
def risk_profile_features(spark: SparkSession, sf: str) -> DataFrame:
    return shown(built_profiles(spark, sf))


@query("freshness_lag")
def freshness_lag(spark: SparkSession, sf: str) -> DataFrame:
    return quality.freshness(txns(spark, sf), at(AS_OF))


@query("recent_ingest_count")
def recent_ingest_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.recent_count(txns(spark, sf), at(AS_OF_HOUR))


@query("profile_min_count")
def profile_min_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile_counts(built_profiles(spark, sf), at(AS_OF)).select("profiles")


@query("profile_stale_count")
def profile_stale_count(spark: SparkSession, sf: str) -> DataFrame:
    located_users = events.risk(txns(spark, sf))
    return quality.profile_counts(located_users, at("2024-01-19 12:00:00")).select("stale")


@query("load_count")
def load_count(spark: SparkSession, sf: str) -> DataFrame:
    """What the last of two customer loads counted while it wrote."""
    return loads.customer_loads(spark, sf)[1]


@query("customer_loads")
def customer_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Customers after two published loads of files with broken lines, through the loader."""
    return shown(loads.customer_loads(spark, sf)[0])


@query("profile_loads")
def profile_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles built into the serving table, copied to the history side and loaded."""
    return shown(loads.profile_loads(spark, sf))


@query("quality_gate")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    txn = txns(spark, sf)
    built = profiles.risk_profiles(txn, at(AS_OF))
    seen = profiles.last_locations(txn)
    # Users that the stream saw after the build of the 30th have today's time, others are stale.
    merged = profiles.merge_profiles(built.withColumn("updated_at", at(BUILT)), seen)
    return quality.quality_gate([
        quality.stream_checks(txn, at(AS_OF)), quality.profile_checks(merged, at(AS_OF_HOUR)),
    ])


# Streaming jobs ------------------------------------------------------------------


@query("velocity_5min")
def velocity_5min(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(streams.run_velocity(spark, sf))


@query("velocity_5min_24h")
def velocity_5min_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(streams.run_velocity(spark, sf, DAY_SECONDS))


@query("late_data_policy")
def late_data_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is delivered with its micro-batch; late ones are not counted."""
    rows = streams.run_late(spark, sf, DAY_SECONDS)
    return rows.select("transaction_id", "user_id", "arrived", "velocity_5min", "is_late")


@query("hot_fanout")
def hot_fanout(spark: SparkSession, sf: str) -> DataFrame:
    rows = streams.read_scored(spark, streams.run_hot(spark, sf, DAY_SCORING))
    return rows.select(
        "transaction_id", "user_id", "fraud_score", "is_flagged", "reasons", *MESSAGE_KEY
    )


@query("hot_ledger")
def hot_ledger(spark: SparkSession, sf: str) -> DataFrame:
    ledger = spark.read.parquet(streams.run_hot(spark, sf).ledger.location)
    return stats.running_totals(ledger).agg(
        F.max("acc_total").alias("acc_total"), F.max("acc_flagged").alias("acc_flagged"),
        F.max("acc_geo_hits").alias("acc_geo_hits"),
    )


def _stored(spark: SparkSession, target: sinks.Target, arrival: str, schema: T.StructType) -> DataFrame:
    return sinks.read_current(spark, target, ["transaction_id"], arrival, schema)


@query("stored_dashboard")
def stored_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """The dashboard's hour from what the stream has stored."""
    since = at(AS_OF_HOUR) - F.expr("INTERVAL 1 HOUR")
    rows = sinks.read_window(
        spark, streams.run_hot(spark, sf).transactions, ["transaction_id"], "event_time",
        "ingest_time", since, SERVING_TRANSACTIONS)
    return shown(serving.dashboard_stats(rows, at(AS_OF_HOUR)))


@query("stored_fraud_scores")
def stored_fraud_scores(spark: SparkSession, sf: str) -> DataFrame:
    raised = _stored(spark, streams.run_hot(spark, sf).fraud_scores, "flagged_at", SERVING_FRAUD_SCORES)
    return shown(serving.recent_fraud_scores(raised))


@query("stored_risky_users")
def stored_risky_users(spark: SparkSession, sf: str) -> DataFrame:
    raised = _stored(spark, streams.run_hot(spark, sf).fraud_scores, "flagged_at", SERVING_FRAUD_SCORES)
    return serving.top_risky_users(raised, at("2024-01-21 00:00:00"))


@query("folded_transactions")
def folded_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Last write wins over base and batch folders: every seventh transaction arrives again a day
    later, every eleventh at the same time in a later batch."""
    rows = sinks.conform(sinks.serving_transactions(scored(spark, sf)), SERVING_TRANSACTIONS)
    number = F.col("transaction_id").cast("long")
    later = rows.filter(number % 7 == 0).withColumns({
        "status": F.lit("later"), "ingest_time": F.col("ingest_time") + F.expr("INTERVAL 1 DAY")})
    same = rows.filter((number % 11 == 0) & (number % 7 != 0)).withColumn("status", F.lit("again"))
    target = streams.run_folded(
        spark, rows, later.unionByName(same), "transaction_id", "ingest_time", SERVING_TRANSACTIONS)
    return shown(_stored(spark, target, "ingest_time", SERVING_TRANSACTIONS).select(
        "transaction_id", "status", "ingest_time", "velocity_5min", "fraud_score", "is_flagged"))


@query("folded_newest_alerts")
def folded_newest_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The newest alerts from base and batch folders, the days walked backwards; every third alert is
    raised again a day later."""
    rows = sinks.conform(alerts(spark, sf), SERVING_FRAUD_SCORES)
    again = rows.filter(F.col("transaction_id").cast("long") % 3 == 0).withColumns({
        "reasons": F.lit("AGAIN"), "flagged_at": F.col("flagged_at") + F.expr("INTERVAL 1 DAY")})
    target = streams.run_folded(
        spark, rows, again, "transaction_id", "flagged_at", SERVING_FRAUD_SCORES)
    return shown(serving.recent_fraud_scores(sinks.read_newest(
        spark, target, ["transaction_id"], "flagged_at", 20, SERVING_FRAUD_SCORES)))


@query("dlq_stream")
def dlq_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _dead_letters(streams.run_dlq(spark, sf)).drop("topic", "ingest_time")


@query("lake_stream")
def lake_stream(spark: SparkSession, sf: str) -> DataFrame:
    return shown(streams.run_lake(spark, sf).select(
        "event_date", "transaction_id", "amount", "event_time", "ingest_time", "fraud_score", *MESSAGE_KEY
    ))
