"""Command line of the jobs, for spark-submit:

    python -m tillwatch.jobs score --messages /data/raw --out /data/out --checkpoint /data/cp

Sources and topics are folders of files, or Kafka with ``--format kafka`` and
``--option kafka.bootstrap.servers=...``; then ``--messages`` is the topic to read.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.config import ScoringConfig
from tillwatch.operators import serving
from tillwatch.operators.joins import latest_by_key
from tillwatch.operators.maintenance import compact
from tillwatch.plans import daily
from tillwatch.plans.tables import create_serving_tables, create_tables
from tillwatch.schemas import LOCATIONS, SERVING_FRAUD_SCORES, SERVING_TRANSACTIONS
from tillwatch.session import build_session
from tillwatch.sources import messages as topics
from tillwatch.sources.tables import (
    CUSTOMER_TTL_SECONDS, RISK_TTL_SECONDS, Refreshed, load_customers, load_risk, or_empty,
    table_version,
)
from tillwatch.streaming import hot, lake
from tillwatch.streaming.keyed import BUCKETS
from tillwatch.streaming.sinks import (
    MAX_SKEW, Target, fold, read_arrived, read_newest, read_window,
)


def _options(args: argparse.Namespace) -> dict[str, str]:
    return dict(option.split("=", 1) for option in args.option)


def _trigger(args: argparse.Namespace, default: str) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.trigger or default}


def _wait(spark: SparkSession, queries: list, once: bool) -> None:
    if not once:
        hot.supervise(spark)
    for query in queries:
        query.awaitTermination()


def init(spark: SparkSession, args: argparse.Namespace) -> None:
    create_tables(spark, args.lake, args.format, args.root)
    create_serving_tables(spark, args.serving, root=args.root)


def customers(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = daily.load_customers_job(spark, args.csv, args.table)
    print(f"{counts['rows']} customers loaded, {counts['rejected']} lines rejected")


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """The scoring query and the dead-letter query, each with its own checkpoint."""
    options = _options(args)

    def topic(name: str, topic_name: str) -> Target:
        if args.format == "kafka":
            return Target(topic_name, "kafka", options)
        return Target(f"{args.out}/{name}")

    def keyed(name: str) -> Target:
        if args.serving_format:
            return Target(f"{args.serving}.{name}", args.serving_format, serving_options)
        return Target(f"{args.out}/{name}")

    serving_options = dict(option.split("=", 1) for option in args.serving_option)
    ctx = hot.HotContext(
        hot.HotTargets(
            transactions=keyed("transactions"),
            fraud_scores=keyed("fraud_scores"),
            locations=keyed("locations"),
            alerts=topic("alerts", topics.ALERTS_TOPIC),
            clean=topic("clean", topics.CLEAN_TOPIC),
            scored=topic("scored", topics.SCORED_TOPIC),
            ledger=Target(f"{args.out}/ledger"),
        ),
        Refreshed(lambda: load_customers(spark, args.customers), CUSTOMER_TTL_SECONDS,
                  version=lambda: table_version(spark, args.customers)),
        Refreshed(lambda: load_risk(spark, args.risk), RISK_TTL_SECONDS,
                  version=lambda: table_version(spark, args.risk)),
        ScoringConfig.from_env(),
    )
    stream = topics.read_raw_stream(spark, args.messages, args.format, args.rate_cap, options)
    trigger = _trigger(args, hot.TRIGGER)
    _wait(spark, [
        hot.start_dlq(stream, topic("dlq", topics.DLQ_TOPIC), args.checkpoint, trigger,
                      args.strict_parse, args.max_future_skew),
        hot.start_hot(stream, ctx, args.checkpoint, trigger, args.strict_parse, args.max_future_skew),
    ], args.once)


def history(spark: SparkSession, args: argparse.Namespace) -> None:
    stream = topics.read_scored_stream(
        spark, args.messages, args.format, args.rate_cap, _options(args))
    if not args.path and not args.table:
        raise SystemExit("history: give --path or --table")
    quarantine = Target(f"{args.path}_quarantine" if args.path else f"{args.checkpoint}/quarantine")
    query = lake.start_lake(
        stream, args.path, args.checkpoint, quarantine, _trigger(args, lake.TRIGGER), args.table)
    _wait(spark, [query], args.once)


KEY = ["transaction_id"]


def _served(spark: SparkSession, path: str, window: str) -> DataFrame:
    """Current transactions with an event in the window; older files are not read."""
    since = F.current_timestamp() - F.expr(f"INTERVAL {window}")
    return read_window(
        spark, Target(path), KEY, "event_time", "ingest_time", since, SERVING_TRANSACTIONS)


def profiles(spark: SparkSession, args: argparse.Namespace) -> None:
    # A day more than the profiles look back, as the clock moves on until they do.
    locations = None
    if args.locations:
        seen = or_empty(spark, lambda: spark.read.schema(LOCATIONS).parquet(args.locations), LOCATIONS)
        locations = latest_by_key(seen, ["user_id"], ["updated_at", *LOCATIONS.fieldNames()[1:3]])
    rows = daily.daily_refresh(
        spark, _served(spark, args.transactions, "31 DAYS"), args.serving, args.lake, args.history,
        min_count=args.min_count, locations=locations,
    )
    print(f"{rows} profiles refreshed")


def reconcile(spark: SparkSession, args: argparse.Namespace) -> None:
    """By arrival, so that a replay of old events counts. A stream in which nothing arrived
    for a day fails with an unknown lag."""
    since = F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    daily.reconcile(read_arrived(
        spark, Target(args.transactions), KEY, "ingest_time", since, SERVING_TRANSACTIONS))


def dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    """The dashboard's answers from what the scoring stream has stored."""
    now = F.current_timestamp()
    serving.with_flag_rate(serving.dashboard_stats(
        _served(spark, f"{args.out}/transactions", "1 HOUR"), now)).show(truncate=False)
    since = now - F.expr("INTERVAL 24 HOURS")
    raised = read_arrived(
        spark, Target(f"{args.out}/fraud_scores"), KEY, "flagged_at", since, SERVING_FRAUD_SCORES)
    serving.top_risky_users(raised, now, args.top).show(truncate=False)
    newest = read_newest(
        spark, Target(f"{args.out}/fraud_scores"), KEY, "flagged_at", args.top, SERVING_FRAUD_SCORES)
    serving.recent_fraud_scores(newest, args.top).show(truncate=False)


def folding(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold the closed batches of both keyed tables; for a scheduler, next to the stream."""
    for name, arrival, schema in (("transactions", "ingest_time", SERVING_TRANSACTIONS),
                                  ("fraud_scores", "flagged_at", SERVING_FRAUD_SCORES)):
        parts = fold(spark, Target(f"{args.out}/{name}"), KEY, arrival, schema, args.buckets)
        print(f"{name}: {parts} partitions rewritten")


def compaction(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{compact(spark, args.path)} partitions rewritten")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillwatch")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for argument in required:
            sub.add_argument(f"--{argument}", required=True)
        return sub

    sub = job("init", init, "lake", "serving")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--root")
    job("customers", customers, "csv", "table")
    for name, run, required in (
        ("score", score, ("messages", "out", "checkpoint", "customers", "risk")),
        ("history", history, ("messages", "checkpoint")),
    ):
        sub = job(name, run, *required)
        sub.add_argument("--format", default="parquet")
        sub.add_argument("--option", action="append", default=[])
        sub.add_argument("--rate-cap", type=int)
        sub.add_argument("--trigger")
        sub.add_argument("--once", action="store_true")
        if name == "score":
            sub.add_argument("--strict-parse", action="store_true")
            sub.add_argument("--max-future-skew", default=MAX_SKEW)
            sub.add_argument("--serving-format", help="connector of keyed serving tables")
            sub.add_argument("--serving", default="serving", help="their database")
            sub.add_argument("--serving-option", action="append", default=[])
        else:
            sub.add_argument("--path")
            sub.add_argument("--table", help="catalog table that supports MERGE, in place of --path")
    sub = job("profiles", profiles, "transactions", "serving", "lake")
    sub.add_argument("--history")
    sub.add_argument("--locations", help="folder of streamed locations to merge in")
    sub.add_argument("--min-count", type=int, default=daily.MIN_PROFILES)
    job("dashboard", dashboard, "out").add_argument("--top", type=int, default=20)
    job("fold", folding, "out").add_argument("--buckets", type=int, default=BUCKETS)
    job("reconcile", reconcile, "transactions")
    job("compact", compaction, "path")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session("tillwatch"), args)


if __name__ == "__main__":
    main()
