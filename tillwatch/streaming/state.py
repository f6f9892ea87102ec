"""Stateful per-user velocity.

Only user id and event time enter the state operator. They are counted per task before
the shuffle, so a hot user arrives as a few counts; the transactions themselves pass
by unshuffled in a second branch of the same query and meet their user's count again in
``stamp_velocity``, inside the micro-batch that both belong to.

State is a short summary of the user (newest time, count within the span, last batch), which also
holds the times and counts of a user with few of them, so that most users cost one read and one
write. Beyond ``INLINE`` times they are kept in a map from time slot to the times and counts in it. A
micro-batch then reads and writes the slots its rows fall into, and reads the slots that the start
of the span has passed since; what lies between is neither read nor written, however much the
user has done. A timer drops idle users.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwatch.config import DEFAULT_JOIN, JoinPolicy
from tillwatch.operators.joins import Size, left_join_unique

ROW, USER = "row", "user"
# Slots in a span. A slot is what a micro-batch rewrites for one row in it.
SLOTS = 32
# Distinct times of a user that are kept in one value, read and written whole, before there are slots.
INLINE = 64
# Rows of a task that are counted at a time before the shuffle.
CHUNK = 1_000_000
_COUNTS = "user_id string, velocity_5min long, counted_from long"


def merge_counts(times: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct times in order, with the sum of their counts."""
    distinct, where = np.unique(times, return_inverse=True)
    summed = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(summed, where, counts)
    return distinct, summed


class SlotVelocity(StatefulProcessor):
    """Counts each user's events of the last ``span_us`` before the newest of them, the end
    included, with one row per user and micro-batch. Up to ``inline`` distinct times of a user are
    kept in the summary itself, more of them in slots."""

    def __init__(self, span_us: int, idle_ms: int, inline: int = 0) -> None:
        self.span, self.idle, self.inline = span_us, idle_ms, inline
        self.width = max(1, span_us // SLOTS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.summary = handle.getValueState("summary", "newest long, total long, seen_ms long, recent binary")
        self.slots = handle.getMapState("slots", "slot long", "event_us array<bigint>, n array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        total, start = self._count(
            np.concatenate([f["event_us"].to_numpy(np.int64) for f in frames]),
            np.concatenate([f["n"].to_numpy(np.int64) for f in frames]), timerValues)
        yield pd.DataFrame({"user_id": [key[0]], "velocity_5min": [total], "counted_from": [start]})

    def _count(self, times: np.ndarray, counts: np.ndarray, timerValues) -> tuple[int, int]:
        """Number of events in the span and its start, after these events."""
        now, held = timerValues.getCurrentProcessingTimeInMs(), self.summary.get()
        newest, total, before, recent = int(times.max()), 0, None, None
        if held is None:
            self.handle.registerTimer(now + self.idle)
        else:
            before, total, _, recent = held
            newest = max(newest, before)
        start = newest - self.span
        counted = times >= start
        times, counts = merge_counts(times[counted], counts[counted])
        if before is None or before < start:
            # Nothing was held, or all of it lies before the new start.
            if before is not None and recent is None:
                self.slots.clear()
            before, total = None, 0
        elif recent is None:
            total -= self._passed(before - self.span, start)
        else:
            former = np.frombuffer(recent, np.int64).reshape(2, -1)
            former = former[:, former[0] >= start]
            times, counts = merge_counts(
                np.concatenate([former[0], times]), np.concatenate([former[1], counts]))
            before, total = None, 0
        total += int(counts.sum())
        if before is None and len(times) <= self.inline:
            self.summary.update((newest, total, now, np.concatenate([times, counts]).tobytes()))
        else:
            self._add(times, counts, before)
            self.summary.update((newest, total, now, None))
        return total, start

    def _passed(self, old: int, new: int) -> int:
        """Number of events from ``old`` until before ``new``; slots that end there are dropped.
        The slot that ``new`` lies in stays whole: what it holds from before is never counted again."""
        if new == old:
            return 0
        first, last, gone = old // self.width, new // self.width, 0
        if last - first > SLOTS // 4:
            slots = [slot for slot, in self.slots.keys() if first <= slot <= last]
        else:
            slots = [slot for slot in range(first, last + 1) if self.slots.containsKey((slot,))]
        for slot in slots:
            gone += self._from(slot, old, new)
            if slot < last:
                self.slots.removeKey((slot,))
        return gone

    def _from(self, slot: int, old: int, new: int) -> int:
        times, counts = map(np.asarray, self.slots.getValue((slot,)))
        return int(counts[(times >= old) & (times < new)].sum())

    def _add(self, times: np.ndarray, counts: np.ndarray, newest: int | None) -> None:
        """Adds distinct ordered times to the slots, which hold none after ``newest`` (None: nothing)."""
        slots, edges = np.unique(times // self.width, return_index=True)
        for slot, low, high in zip(slots.tolist(), edges, [*edges[1:], len(times)]):
            held, n = times[low:high], counts[low:high]
            if newest is not None and slot <= newest // self.width and self.slots.containsKey((slot,)):
                before = self.slots.getValue((slot,))
                held, n = merge_counts(np.concatenate([np.asarray(before[0], np.int64), held]),
                                       np.concatenate([np.asarray(before[1], np.int64), n]))
            self.slots.updateValue((slot,), (held.tolist(), n.tolist()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Drops a user who has been idle; another gets a timer for when that could be. So an
        active user costs no timer per micro-batch."""
        if self.summary.exists():
            due = self.summary.get()[2] + self.idle
            if due > timerValues.getCurrentProcessingTimeInMs():
                self.handle.registerTimer(due)
            else:
                self.summary.clear()
                self.slots.clear()
        return iter([])

    def close(self) -> None:
        pass


class UserVelocity(SlotVelocity):
    """The same on plain rows. A user with few rows costs some calls to the state, where a data
    frame in and one out cost as much again several times over."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times, counts = np.concatenate(
            [np.frombuffer(r["events"], np.int64).reshape(2, -1) for r in rows], axis=1)
        total, start = self._count(times, counts, timerValues)
        yield Row(user_id=key[0], velocity_5min=total, counted_from=start)


def _count_in_task(span_us: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per user for every ``CHUNK`` rows of a task: distinct times and their counts, one
    after the other. What lies a span before the user's newest time in there is never counted, so
    it is left out."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).drop_null().combine_chunks()
        users = pc.dictionary_encode(rows["user_id"]).combine_chunks()
        user, time = users.indices.to_numpy(), rows["event_us"].to_numpy()
        order = np.lexsort((time, user))
        user, time = user[order], time[order]
        first = np.flatnonzero(np.diff(user, prepend=-1).astype(bool) | np.diff(time, prepend=0).astype(bool))
        counts = np.diff(first, append=len(user))
        user, time = user[first], time[first]
        newest = np.zeros(len(users.dictionary), np.int64)
        newest[user] = time
        counted = time >= newest[user] - span_us
        user, time, counts = user[counted], time[counted], counts[counted]
        edges = np.flatnonzero(np.diff(user, prepend=-1, append=-1))
        events = [np.concatenate([time[a:b], counts[a:b]]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
        return pa.RecordBatch.from_arrays(
            [users.dictionary.take(pa.array(user[edges[:-1]])), pa.array(events, pa.binary())],
            names=["user_id", "events"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    return count


def _dealt_evenly(good: DataFrame) -> DataFrame:
    """The rows in as many even parts as the session shuffles into, whatever the files or topic
    partitions they came from. Every column is part of the key, so that none is pruned in one branch of
    a query only: both branches then read one exchange, and messages are read and parsed once."""
    return good.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in good.columns]))


def velocity_stateful(good: DataFrame, seconds: int = 300, idle_ms: int = 600_000) -> DataFrame:
    """Transactions and one count per user of the micro-batch, told apart by ``_kind``.

    The rule: all event times of the user so far, together with this micro-batch, are
    cut to the last ``seconds`` before the newest of them, the end included; their
    number holds for every row the user has in the micro-batch. A late row (one before
    ``counted_from``, the start of the span in microseconds) is not counted but is still
    delivered. State is dropped after ``idle_ms`` without rows.
    Drop columns such as ``raw_json`` beforehand when nothing downstream needs them.
    """
    good = _dealt_evenly(good)
    per_user = (
        good.select("user_id", F.unix_micros("event_time").alias("event_us"))
        .mapInArrow(_count_in_task(seconds * 1_000_000), "user_id string, events binary")
        .groupBy("user_id")
        .transformWithState(
            UserVelocity(seconds * 1_000_000, idle_ms, INLINE), _COUNTS, "append", "ProcessingTime")
        .withColumn("_kind", F.lit(USER))
    )
    rows = good.withColumns({"k_partition": F.col("k_partition").cast("long"), "_kind": F.lit(ROW)})
    return rows.unionByName(per_user, allowMissingColumns=True)


def batch_users(tagged: DataFrame) -> DataFrame:
    """(user_id, velocity_5min) of the users in one micro-batch."""
    return tagged.filter(F.col("_kind") == USER).select("user_id", "velocity_5min")


def batch_rows(tagged: DataFrame) -> DataFrame:
    """The transactions of one micro-batch, without their velocity."""
    return tagged.filter(F.col("_kind") == ROW).drop(
        "_kind", "velocity_5min", "counted_from")


def stamp_velocity(
    tagged: DataFrame, policy: JoinPolicy = DEFAULT_JOIN, size: Size | None = None
) -> DataFrame:
    """Micro-batch of ``velocity_stateful`` to transactions with their velocity."""
    return left_join_unique(batch_rows(tagged), batch_users(tagged), ["user_id"], policy, size)


def stamp_lateness(
    tagged: DataFrame, policy: JoinPolicy = DEFAULT_JOIN, size: Size | None = None
) -> DataFrame:
    """``stamp_velocity`` with ``is_late``: whether the row came after its user's span had passed
    it, in this micro-batch or an earlier one, so that it is delivered without being counted."""
    users = tagged.filter(F.col("_kind") == USER).select("user_id", "velocity_5min", "counted_from")
    rows = left_join_unique(batch_rows(tagged), users, ["user_id"], policy, size)
    late = F.unix_micros("event_time") < F.col("counted_from")
    return rows.withColumn("is_late", late).drop("counted_from")
