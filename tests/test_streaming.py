"""Streaming queries on named message files, one file per micro-batch."""

from __future__ import annotations

import json
import os
import random
import time
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillwatch.config import JoinPolicy, ScoringConfig
from tillwatch.operators.ingest import validated
from tillwatch.operators.joins import Size
from tillwatch.schemas import CUSTOMERS, LEDGER, MESSAGE, RISK_PROFILES
from tillwatch.sources.messages import parse_scored, read_raw_stream, read_scored_stream
from tillwatch.sources.tables import Refreshed
from tillwatch.streaming import hot, lake, sinks, state
from tillwatch.streaming.sinks import Batch, Target

T0 = datetime(2024, 1, 1, 12, 0, 0)
ONCE = {"availableNow": True}
WAIT = 60


class Topic:
    """A folder of message files, each file one micro-batch in order of its time."""

    def __init__(self, spark, folder: Path) -> None:
        self.spark, self.path, self.files, self.offset = spark, folder / "raw", 0, 0
        self.path.mkdir()
        self.staging = folder / "staging"

    def send(self, bodies: list[dict | str | None]) -> list[int]:
        texts = [b if b is None or isinstance(b, str) else json.dumps(b) for b in bodies]
        offsets = list(range(self.offset, self.offset + len(texts)))
        self.offset += len(texts)
        data = [("transactions-raw", 0, o, t) for o, t in zip(offsets, texts)]
        staged = self.staging / str(self.files)
        self.spark.createDataFrame(data, MESSAGE).coalesce(1).write.parquet(str(staged))
        target = self.path / f"{self.files:05d}.parquet"
        next(staged.glob("*.parquet")).rename(target)
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return offsets

    def stream(self):
        return read_raw_stream(self.spark, str(self.path), rate_cap=1)


def txn(number, user, second, amount=10.0, lat=0.0, lon=0.0):
    return {
        "transaction_id": f"t{number}", "user_id": user, "amount": amount, "merchant_id": "m",
        "merchant_lat": lat, "merchant_lon": lon, "status": "pending",
        "timestamp": (T0 + timedelta(seconds=second)).isoformat() + "Z",
    }


def targets(root: Path) -> hot.HotTargets:
    names = ["transactions", "fraud_scores", "locations", "alerts", "clean", "scored", "ledger"]
    return hot.HotTargets(**{name: Target(str(root / name)) for name in names})


def context(spark, root, customers=(), risk=(), scoring=ScoringConfig(), policy=JoinPolicy()):
    people = spark.createDataFrame(list(customers), CUSTOMERS)
    places = spark.createDataFrame(list(risk), RISK_PROFILES)
    return hot.HotContext(
        targets(root), Refreshed(lambda: people), Refreshed(lambda: places), scoring, policy)


def run(query):
    assert query.awaitTermination(WAIT), "query did not end"


class VelocityModel:
    """The state rule in plain Python, one call per micro-batch."""

    def __init__(self, seconds=300):
        self.seconds, self.held = seconds, {}

    def batch(self, bodies):
        for body in bodies:
            t = datetime.fromisoformat(body["timestamp"]).timestamp()
            self.held.setdefault(body["user_id"], []).append(t)
        counts = {}
        for user in {b["user_id"] for b in bodies}:
            newest = max(self.held[user])
            self.held[user] = [t for t in self.held[user] if t >= newest - self.seconds]
            counts[user] = len(self.held[user])
        return {b["transaction_id"]: counts[b["user_id"]] for b in bodies}


def test_velocity_matches_the_model_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(7)
    topic, model, expected = Topic(spark, tmp_path), VelocityModel(), {}
    batches = [
        # six in a burst; exactly 300 s before the newest still counts, one more does not
        [txn(i, "burst", i) for i in range(6)] + [txn(6, "edge", 0), txn(7, "edge", 300)],
        # a late row is delivered but not counted; a far event empties the window
        [txn(8, "edge", 301), txn(9, "edge", -400), txn(10, "burst", 10_000)],
        [txn(11 + i, f"u{rng.randrange(3)}", rng.randrange(900)) for i in range(40)],
        [txn(51 + i, f"u{rng.randrange(3)}", 400 + rng.randrange(900)) for i in range(40)],
    ]
    for bodies in batches:
        expected.update(model.batch(bodies))
    ctx = context(spark, tmp_path)
    for first, last in ((0, 2), (2, 4)):
        for bodies in batches[first:last]:
            topic.send(bodies)
        run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "checkpoint"), ONCE))
    stored = spark.read.parquet(ctx.targets.transactions.location)
    got = {r["transaction_id"]: r["velocity_5min"] for r in stored.collect()}
    assert got == expected
    assert got["t0"] == 6 and got["t7"] == 2 and got["t8"] == 2 and got["t9"] == 2 and got["t10"] == 1
    scores = {r["transaction_id"]: r["fraud_score"] for r in stored.collect()}
    assert scores["t0"] == 40 and scores["t10"] == 0


def test_merge_counts_is_exact():
    times = np.array([5, 1, 5, 9, 4], dtype=np.int64)
    kept, counts = state.merge_counts(times, np.array([1, 7, 2, 1, 1]))
    assert kept.tolist() == [1, 4, 5, 9] and counts.tolist() == [7, 1, 3, 1]
    empty = np.array([], dtype=np.int64)
    assert len(state.merge_counts(empty, empty)[0]) == 0


class HeldState:
    """The state of one key in plain dictionaries, with a count of the slots touched."""

    class Value:
        def __init__(self):
            self.row = None

        def exists(self):
            return self.row is not None

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

        def clear(self):
            self.row = None

    class Map:
        def __init__(self):
            self.rows, self.read, self.wrote = {}, set(), set()

        def keys(self):
            return iter(list(self.rows))

        def containsKey(self, key):
            return key in self.rows

        def getValue(self, key):
            self.read.add(key)
            return self.rows[key]

        def updateValue(self, key, row):
            self.wrote.add(key)
            self.rows[key] = row

        def removeKey(self, key):
            del self.rows[key]

        def clear(self):
            self.rows = {}

    def __init__(self):
        self.timers, self.now = [], 0

    def getValueState(self, *_):
        return self.Value()

    def getMapState(self, *_):
        return self.Map()

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def counter(span_us, idle_ms=1000):
    held, operator = HeldState(), state.SlotVelocity(span_us, idle_ms)
    operator.init(held)

    def batch(*times):
        frame = pd.DataFrame({"event_us": times, "n": 1})
        half = len(frame) // 2
        parts = iter([f for f in (frame[:half], frame[half:]) if len(f)])
        operator.slots.read, operator.slots.wrote = set(), set()
        return next(operator.handleInputRows(("u",), parts, held))["velocity_5min"].item()

    return held, operator, batch


@pytest.mark.parametrize("span", [3, 64, 1000])
def test_slots_count_what_the_model_counts(span):
    rng = random.Random(span)
    for _ in range(60):
        _, operator, batch = counter(span)
        held, at = [], 0
        for _ in range(25):
            at += rng.choice([0, 1, span // 3, span, 5 * span, 100 * span]) - rng.choice([0, 0, span // 2])
            times = [at + rng.randrange(-2 * span, 2 * span) for _ in range(rng.randrange(1, 9))]
            held = [t for t in held + times if t >= max(held + times) - span]
            assert batch(*times) == len(held)
            assert len(operator.slots.rows) <= (state.SLOTS + 1) * (span // operator.width / state.SLOTS) + 1


def test_a_batch_touches_its_own_slots_only():
    held, operator, batch = counter(3200)
    batch(*range(0, 3200))
    assert batch(3205, 3206) == 3196 and len(operator.slots.rows) == 33
    assert operator.slots.wrote == {(32,)} and operator.slots.read == {(0,)}
    assert batch(3299, 3310, 3205) == 3200 - 110 + 5
    assert operator.slots.wrote == {(32,), (33,)} and operator.slots.read == {(0,), (1,), (32,)}
    assert (0,) not in operator.slots.rows


def test_timer_waits_for_the_last_batch():
    held, operator, batch = counter(3200, idle_ms=1000)
    batch(1)
    assert held.timers == [1000]
    held.now = 700
    batch(2)
    held.now = 1000
    assert list(operator.handleExpiredTimer(("u",), held, None)) == [] and held.timers == [1000, 1700]
    assert operator.summary.exists() and operator.slots.rows
    held.now = 1700
    list(operator.handleExpiredTimer(("u",), held, None))
    assert not operator.summary.exists() and not operator.slots.rows
    assert batch(3) == 1 and held.timers[-1] == 2700


def test_state_written_does_not_grow_with_the_history(spark, tmp_path):
    """A row after a full span of events rewrites as few state rows as one after a single event."""
    topic = Topic(spark, tmp_path)
    topic.send([txn(0, "few", 0), *[txn(1 + i, "many", i / 10) for i in range(3000)]])
    topic.send([txn(5000, "few", 301)])
    topic.send([txn(5001, "many", 301)])
    good, _ = validated(topic.stream())
    writer = state.velocity_stateful(good).writeStream.foreachBatch(lambda df, _: df.count())
    query = hot.start_stateful(writer.option("checkpointLocation", str(tmp_path / "c")), spark, ONCE)
    run(query)
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert updated[0] > 30 and updated[2] <= updated[1] + 1 <= 4


def test_messages_are_parsed_once_and_dealt_over_all_tasks(spark, tmp_path):
    """Both branches of the query parsed the messages, in as many tasks as the file had parts."""
    topic, parts = Topic(spark, tmp_path), []
    topic.send([txn(i, f"u{i % 7}", i) for i in range(200)])
    good, _ = validated(topic.stream())

    def on_batch(df, _):
        parts.extend(r[0] for r in state.batch_rows(df).groupBy(F.spark_partition_id()).count().collect())

    writer = state.velocity_stateful(good.drop("raw_json")).writeStream.foreachBatch(on_batch)
    query = hot.start_stateful(writer.option("checkpointLocation", str(tmp_path / "c")), spark, ONCE)
    run(query)
    made = query._jsq.explainInternal(False)
    assert made.count("from_json(") == 1 and "ReusedExchange" in made
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def until(condition, seconds=WAIT):
    """Poll; a query with idle timeouts keeps running empty batches, so waiting for it
    to have nothing left to do would not end."""
    end = time.monotonic() + seconds
    while not condition():
        assert time.monotonic() < end, "condition not met in time"
        time.sleep(0.2)


def test_idle_state_is_dropped(spark, tmp_path):
    seen = {}

    def on_batch(df, number):
        for r in state.stamp_velocity(df).collect():
            seen[r["transaction_id"]] = r["velocity_5min"]

    topic = Topic(spark, tmp_path)
    topic.send([txn(1, "u", 0)])
    good, _ = validated(topic.stream())
    query = (
        state.velocity_stateful(good, idle_ms=1).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="1 second").start()
    )

    def held():
        progress = query.lastProgress
        return progress["stateOperators"][0]["numRowsTotal"] if progress else None

    try:
        until(lambda: "t1" in seen)
        until(lambda: held() == 0)
        topic.send([txn(3, "u", 1)])
        until(lambda: "t3" in seen)
    finally:
        query.stop()
    assert seen == {"t1": 1, "t3": 1}


@pytest.fixture(scope="module")
def fanout(spark, tmp_path_factory):
    """Two micro-batches with flagged, plain and broken messages."""
    root = tmp_path_factory.mktemp("fanout")
    topic = Topic(spark, root)
    customers = [("u", "BASIC", 10.0, 100.0), ("u", "BASIC", 5.0, 1.0), ("v", "PREMIUM", 50.0, 1.0)]
    risk = [("u", None, None, None, 0.0, 0.0, T0 - timedelta(hours=1))]
    ctx = context(spark, root, customers, risk)
    topic.send([
        txn(1, "u", 0, amount=500.0, lat=45.0, lon=90.0),   # amount and place
        txn(2, "u", 1, amount=5.0), txn(3, "v", 0, amount=40.0), txn(4, "stranger", 0),
        "{bad", None, txn(5, "u", 0, amount=-1.0),
    ])
    topic.send([txn(i, "u", 60 + i, amount=500.0) for i in range(6, 12)])  # burst and amount
    run(hot.start_hot(topic.stream(), ctx, str(root / "checkpoint"), ONCE))
    dlq = Target(str(root / "dlq"))
    run(hot.start_dlq(topic.stream(), dlq, str(root / "checkpoint"), ONCE))
    return root, topic, ctx, dlq


def test_fanout_writes_every_sink(spark, fanout):
    _, _, ctx, dlq = fanout
    to = ctx.targets
    stored = spark.read.parquet(to.transactions.location)
    scores = {r["transaction_id"]: (r["fraud_score"], r["plan"]) for r in stored.collect()}
    assert scores["t1"] == (60, "BASIC") and scores["t2"] == (0, "BASIC")
    assert scores["t3"] == (0, "PREMIUM") and scores["t4"] == (0, "unknown")
    assert {scores[f"t{i}"] for i in range(6, 12)} == {(70, "BASIC")}
    assert dict(stored.dtypes)["amount"] == "decimal(18,2)"
    flagged = spark.read.parquet(to.fraud_scores.location)
    assert rows(flagged, "transaction_id", "reasons")[0] == ("t1", "AMOUNT_ANOMALY,GEO_IMPOSSIBLE")
    assert flagged.count() == 7 and flagged.filter("reviewed IS NOT NULL").isEmpty()
    alerts = [json.loads(r["value"]) for r in spark.read.parquet(to.alerts.location).collect()]
    assert {a["transaction_id"] for a in alerts} == {"t1", *[f"t{i}" for i in range(6, 12)]}
    assert set(alerts[0]) == {
        "transaction_id", "user_id", "amount", "fraud_score", "reasons", "flagged_at"}
    clean = spark.read.parquet(to.clean.location)
    assert clean.count() == 10 and clean.filter("key = 'u'").count() == 8
    locations = rows(spark.read.parquet(to.locations.location), "user_id", "updated_at")
    assert ("u", T0 + timedelta(seconds=71)) in locations and len(locations) == 4
    dead = [json.loads(r["value"]) for r in spark.read.parquet(dlq.location).collect()]
    assert sorted((d["offset"], d["reason"]) for d in dead) == [
        (4, "missing_transaction_id"), (5, "schema_parse_error"), (6, "non_positive_amount")]


def test_ledger_has_one_row_per_batch_and_totals_add_up(spark, fanout):
    from tillwatch.operators.stats import running_totals

    ledger = spark.read.parquet(fanout[2].targets.ledger.location)
    assert set(LEDGER.fieldNames()) <= set(ledger.columns)
    totals = rows(running_totals(ledger).drop("query_id"))
    assert totals == [(0, 4, 1, 1, 4, 1, 1), (1, 6, 6, 0, 10, 7, 1)]


def test_replayed_batch_changes_nothing(spark, fanout):
    """The same batch again, with and without its ledger row."""
    root, _, ctx, _ = fanout
    tagged = spark.createDataFrame(
        [("t1", "u", 1.0, "m", None, None, "s", T0, T0, "{}", "transactions-raw", 0, 0, "row", None),
         (None, "u", None, None, None, None, None, None, None, None, None, None, None, "user", 1)],
        "transaction_id string, user_id string, amount double, merchant_id string, "
        "merchant_lat double, merchant_lon double, status string, event_time timestamp, "
        "ingest_time timestamp, raw_json string, k_topic string, k_partition long, "
        "k_offset long, _kind string, velocity_5min long")
    replay = hot.HotContext(
        targets(root / "replay"), ctx.customers, ctx.risk)
    batch = Batch("query", 3)
    assert hot.process_batch(tagged, batch, replay) == {"total": 1, "flagged": 0, "geo_hits": 0}
    assert hot.process_batch(tagged, batch, replay) is None
    elsewhere = hot.HotTargets(**{
        **replay.targets.__dict__, "ledger": Target(str(root / "replay" / "other_ledger"))})
    hot.process_batch(tagged, batch, hot.HotContext(elsewhere, ctx.customers, ctx.risk))
    for name in ("transactions", "clean", "scored", "locations"):
        assert spark.read.parquet(getattr(replay.targets, name).location).count() == 1


def test_failing_sink_raises(spark, fanout, tmp_path):
    _, topic, ctx, _ = fanout
    broken = hot.HotTargets(**{**targets(tmp_path).__dict__, "clean": Target("x", "no_such_format")})
    query = hot.start_hot(
        topic.stream(), hot.HotContext(broken, ctx.customers, ctx.risk),
        str(tmp_path / "c"), ONCE)
    with pytest.raises(Exception, match="(?i)no_such_format"):
        query.awaitTermination(WAIT)
    assert not Path(broken.ledger.location).exists()


def test_batch_scores_are_the_same_when_nothing_may_be_broadcast(spark, fanout, tmp_path):
    _, topic, ctx, _ = fanout
    shuffled = JoinPolicy(max_broadcast_rows=0, hot_rows=2)
    other = hot.HotContext(
        targets(tmp_path), ctx.customers, ctx.risk, ctx.scoring, shuffled)
    run(hot.start_hot(topic.stream(), other, str(tmp_path / "c"), ONCE))
    columns = ["transaction_id", "velocity_5min", "fraud_score", "plan", "geo_speed_kmh"]
    assert rows(spark.read.parquet(other.targets.transactions.location), *columns) == rows(
        spark.read.parquet(ctx.targets.transactions.location), *columns)


def test_supervision_stops_all_when_one_ends(spark, fanout, tmp_path):
    _, topic, _, _ = fanout
    spark.streams.resetTerminated()
    every = {"processingTime": "1 second"}
    first, second = (
        hot.start_dlq(topic.stream(), Target(str(tmp_path / name)), str(tmp_path / f"c{name}"), every)
        for name in ("a", "b")
    )
    assert first.isActive and second.isActive
    first.stop()
    hot.supervise(spark)
    assert not second.isActive and not spark.streams.active


def test_lake_keeps_each_message_once(spark, fanout, tmp_path):
    _, _, ctx, _ = fanout
    path, quarantine = str(tmp_path / "lake"), Target(str(tmp_path / "quarantine"))
    scored = ctx.targets.scored.location
    for checkpoint in ("a", "b"):  # a new checkpoint reads everything again
        query = lake.start_lake(
            read_scored_stream(spark, scored), path, str(tmp_path / checkpoint), quarantine, ONCE)
        run(query)
    stored = lake.read_lake(spark, path)
    assert stored.count() == 10
    assert stored.select("k_topic", "k_partition", "k_offset").distinct().count() == 10
    assert [p.name for p in Path(path).glob("event_date=*")] == ["event_date=2024-01-01"]


@pytest.mark.parametrize("policy", [JoinPolicy(), JoinPolicy(max_broadcast_rows=0)])
def test_lake_batch_with_copies_and_without_keys(spark, fanout, tmp_path, policy):
    _, _, ctx, _ = fanout
    path, quarantine = str(tmp_path / "lake"), Target(str(tmp_path / "quarantine"))
    batch = parse_scored(spark.read.parquet(ctx.targets.scored.location))
    same_id = batch.filter("transaction_id = 't1'").withColumn("k_offset", F.lit(999).cast("long"))
    no_key = batch.filter("transaction_id = 't2'").withColumn("k_offset", F.lit(None).cast("long"))
    copies = batch.unionByName(batch).unionByName(same_id).unionByName(no_key)
    for _ in range(2):
        lake.merge_batch(copies, path, quarantine, Batch("q", 1), policy)
    stored = lake.read_lake(spark, path)
    assert stored.count() == 11
    assert stored.filter("transaction_id = 't1'").count() == 2
    assert spark.read.parquet(quarantine.location).count() == 1
    with pytest.raises(ValueError, match="without message key"):
        lake.merge_batch(no_key, path, None, Batch("q", 2))


def test_lake_merge_reads_only_files_that_can_hold_the_batch(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows_ = spark.createDataFrame(
        [("raw", 0, i, T0 + timedelta(days=i)) for i in range(100)],
        "k_topic string, k_partition long, k_offset long, event_time timestamp",
    ).withColumn("event_date", F.to_date("event_time"))
    rows_.write.partitionBy("event_date").parquet(path)
    few = lake.candidates(spark, path, rows_.filter("k_offset < 3"))
    assert "GreaterThanOrEqual(k_offset,0), LessThanOrEqual(k_offset,2)" in plan(few)
    assert len(few.inputFiles()) == 3 and few.count() == 3
    assert lake.candidates(spark, path, rows_.filter("k_offset >= 20")).count() == 80
    undated = rows_.withColumn("event_date", F.lit(None).cast("date"))
    assert lake.candidates(spark, path, undated).count() == 100
    new = rows_.limit(1).withColumn("event_date", F.lit("2030-01-01").cast("date"))
    assert lake.candidates(spark, path, new).count() == 0


def test_lake_merge_into_a_table_is_built(spark, fanout):
    """No catalog with MERGE is installed: the plan reaches that point and says so."""
    batch = parse_scored(spark.read.parquet(fanout[2].targets.scored.location))
    batch.limit(0).write.mode("overwrite").saveAsTable("merged_lake")
    with pytest.raises(Exception, match="(?i)merge"):
        lake.merge_into_table(batch, "merged_lake")


def test_stream_goes_on_while_dimensions_are_loaded(spark, tmp_path):
    """A batch, three loads of both dimensions, and the next batch of the same query."""
    from tillwatch.plans import daily
    from tillwatch.plans.tables import create_tables
    from tillwatch.sources.tables import load_customers, load_risk, table_version

    create_tables(spark, "stream_dims")

    def load(number):
        people = spark.createDataFrame([("u", "BASIC", 10.0 * number, 1.0)], CUSTOMERS)
        places = spark.createDataFrame([("u", None, None, None, 0.0, 0.0, T0 - timedelta(hours=number))],
                                       RISK_PROFILES)
        daily.overwrite(people, "stream_dims.customers")
        daily.overwrite(places, "stream_dims.risk_profiles")

    load(1)
    # TTLs that never end: only the table's pointer tells that there is another load.
    ctx = hot.HotContext(
        targets(tmp_path),
        Refreshed(lambda: load_customers(spark, "stream_dims.customers"), 1e9,
                  version=lambda: table_version(spark, "stream_dims.customers")),
        Refreshed(lambda: load_risk(spark, "stream_dims.risk_profiles"), 1e9,
                  version=lambda: table_version(spark, "stream_dims.risk_profiles")))
    topic = Topic(spark, tmp_path)
    topic.send([txn(1, "u", 0, amount=30.0)])
    run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "c"), ONCE))
    for number in (2, 3, 4):
        load(number)
    topic.send([txn(2, "u", 1, amount=40.0)])
    run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "c"), ONCE))
    stored = spark.read.parquet(ctx.targets.transactions.location)
    scores = {r["transaction_id"]: round(r["amount_zscore"], 3) for r in stored.collect()}
    assert scores == {"t1": round(20 / 3, 3), "t2": 0.0}


def test_a_batch_whose_dimension_files_are_gone_is_scored_again(spark, tmp_path):
    folder = tmp_path / "people"
    write = lambda avg: spark.createDataFrame(
        [("u", "BASIC", avg, 1.0)], CUSTOMERS).write.mode("overwrite").parquet(str(folder))
    write(10.0)
    places = spark.createDataFrame([], RISK_PROFILES)
    ctx = hot.HotContext(
        targets(tmp_path), Refreshed(lambda: spark.read.schema(CUSTOMERS).parquet(str(folder)), 1e9),
        Refreshed(lambda: places))
    ctx.customers.get()
    write(20.0)
    topic = Topic(spark, tmp_path)
    topic.send([txn(1, "u", 0, amount=40.0)])
    run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "c"), ONCE))
    assert round(spark.read.parquet(ctx.targets.transactions.location).first()["amount_zscore"], 3) == round(20 / 6, 3)


def test_no_amount_stops_the_stream(spark, tmp_path):
    ctx = context(spark, tmp_path)
    topic = Topic(spark, tmp_path)
    topic.send([txn(1, "u", 0, amount=1e17), txn(2, "u", 1, amount=float("nan")),
                txn(3, "u", 2, amount=float("inf")), txn(4, "u", 3, amount=9e15), txn(5, "u", 4)])
    run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "c"), ONCE))
    run(hot.start_dlq(topic.stream(), Target(str(tmp_path / "dlq")), str(tmp_path / "c"), ONCE))
    stored = spark.read.parquet(ctx.targets.transactions.location)
    assert sorted(r["transaction_id"] for r in stored.collect()) == ["t4", "t5"]
    dead = [json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "dlq")).collect()]
    assert [d["reason"] for d in dead] == ["amount_out_of_range"] * 3


def test_times_keep_their_microseconds(spark, tmp_path):
    ctx = context(spark, tmp_path)
    topic = Topic(spark, tmp_path)
    body = txn(1, "u", 0) | {"timestamp": "2024-01-01T12:00:00.123456Z"}
    topic.send([body])
    run(hot.start_hot(topic.stream(), ctx, str(tmp_path / "c"), ONCE))
    row = parse_scored(spark.read.parquet(ctx.targets.scored.location)).first()
    assert row["event_time"] == T0 + timedelta(microseconds=123456)


def test_adaptive_execution_is_on_inside_the_batch(spark, fanout, tmp_path, monkeypatch):
    _, topic, ctx, _ = fanout
    seen, stats = [], hot.batch_stats

    def spy(df):
        seen.append(df.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return stats(df)

    monkeypatch.setattr(hot, "batch_stats", spy)
    other = hot.HotContext(targets(tmp_path), ctx.customers, ctx.risk)
    run(hot.start_hot(topic.stream(), other, str(tmp_path / "c"), ONCE))
    assert seen == ["true", "true"]


def test_serving_reads_return_the_newest_version(spark, tmp_path):
    target = Target(str(tmp_path / "transactions"))
    data = [("a", 1, 0, 0), ("b", 2, 100, 0), ("c", 3, 10_000, 1), ("b", 4, 90_000, 2), ("a", 5, 50, 3)]
    for number, (key, value, event, arrival) in enumerate(data):
        df = spark.createDataFrame(
            [(key, value, T0 + timedelta(seconds=event), T0 + timedelta(days=1, seconds=arrival))],
            "transaction_id string, value int, event_time timestamp, ingest_time timestamp")
        dated = df.withColumn("arrival_date", F.to_date("ingest_time"))
        sinks.write_batch(dated, target, Batch("q", number), "arrival_date")
    current = sinks.read_current(spark, target, ["transaction_id"], "ingest_time")
    assert rows(current, "transaction_id", "value") == [("a", 5), ("b", 4), ("c", 3)]
    for second in (0, 60, 5_000, 50_000, 100_000):
        since = F.lit(T0 + timedelta(seconds=second))
        windowed = sinks.read_window(
            spark, target, ["transaction_id"], "event_time", "ingest_time", since)
        expected = rows(current.filter(F.col("event_time") >= since), "transaction_id", "value")
        assert rows(windowed, "transaction_id", "value") == expected


def test_refreshed_table_keeps_the_old_copy_when_a_load_fails(spark):
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        if len(loads) == 3:
            raise RuntimeError("store is away")
        return spark.range(len(loads)).select(F.col("id").cast("string").alias("user_id"))

    table = Refreshed(load, ttl_seconds=60, clock=lambda: now[0])
    counts = []
    for now[0] in (0.0, 59.0, 60.0, 121.0, 130.0):
        counts.append(table.get().count())
    assert counts == [1, 1, 2, 2, 4] and loads == [0.0, 60.0, 121.0, 130.0]


def test_large_dimension_is_cut_to_the_users_of_the_batch(spark):
    users = spark.createDataFrame([("7",)], "user_id string")
    big = spark.range(100).select(F.col("id").cast("string").alias("user_id"))
    large = Refreshed(lambda: big, policy=JoinPolicy(max_broadcast_rows=10))
    assert rows(large.for_users(users)) == [("7",)]
    assert Refreshed(lambda: big).for_users(users).count() == 100
    assert not Size(11, 0).fits(JoinPolicy(max_broadcast_rows=10))


def test_users_with_few_times_keep_them_in_one_value():
    """Inline or in slots, whatever way a user takes between them, the count is the model's."""
    rng, kinds = random.Random(9), set()
    for _ in range(60):
        span = rng.choice([64, 1000])
        held_state, operator = HeldState(), state.UserVelocity(span, 1000, 5)
        operator.init(held_state)
        held, at = [], 0
        for _ in range(40):
            at += rng.choice([0, 1, span // 3, span, 5 * span]) - rng.choice([0, 0, span // 2])
            times = [at + rng.randrange(-2 * span, 2 * span) for _ in range(rng.choice([1, 1, 2, 9]))]
            held = [t for t in held + times if t >= max(held + times) - span]
            packed = np.array([times, [1] * len(times)], np.int64)
            parts = iter([{"events": p.tobytes()} for p in (packed[:, :1], packed[:, 1:]) if p.size])
            got = next(operator.handleInputRows(("u",), parts, held_state))
            assert (got["velocity_5min"], got["counted_from"]) == (len(held), max(held) - span)
            inline = operator.summary.get()[3] is not None
            assert not (inline and operator.slots.rows) and (inline or operator.slots.rows)
            kinds.add(inline)
    assert kinds == {True, False}


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_tasks_send_only_what_can_count(monkeypatch, chunk):
    monkeypatch.setattr(state, "CHUNK", chunk)
    users = ["a", "b", "a", None, "a", "b", "a", "c"]
    times = pa.array([100, 50, 100, 7, 89, 60, 200, -5])
    batches = [pa.RecordBatch.from_arrays([pa.array(users), times], names=["user_id", "event_us"])[i:i + 2]
               for i in range(0, 8, 2)]
    found = {}
    for batch in state._count_in_task(10)(iter(batches)):
        for row in batch.to_pylist():
            for t, n in np.frombuffer(row["events"], np.int64).reshape(2, -1).T.tolist():
                found[row["user_id"], t] = found.get((row["user_id"], t), 0) + n
    whole = {("a", 200): 1, ("b", 50): 1, ("b", 60): 1, ("c", -5): 1}
    assert whole.items() <= found.items() and set(found) <= {*whole, ("a", 100), ("a", 89)}
    assert chunk < 1000 or found == whole
