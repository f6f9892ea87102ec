"""Keyed serving folders: folding, reads while folding, newest rows by day."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.sources import files
from tillwatch.streaming import keyed, sinks
from tillwatch.streaming.sinks import Batch, Target

T0 = datetime(2024, 1, 1, 12)
SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()),
    T.StructField("at", T.TimestampType()),
])


class Folder:
    def __init__(self, spark, path):
        self.spark, self.target, self.number, self.rows = spark, Target(str(path)), 0, []

    def write(self, data, query="q"):
        """(id, value, hours after T0)"""
        data = [(i, v, T0 + timedelta(hours=h)) for i, v, h in data]
        self.rows += [(*r, self.number) for r in data]
        dated = self.spark.createDataFrame(data, SCHEMA).withColumn("arrival_date", F.to_date("at"))
        sinks.write_batch(dated, self.target, Batch(query, self.number), "arrival_date")
        self.number += 1

    def fold(self, **options):
        return sinks.fold(self.spark, self.target, ["id"], "at", SCHEMA, **options)

    def current(self):
        return rows(sinks.read_current(self.spark, self.target, ["id"], "at", SCHEMA), "id", "v")

    def expected(self):
        best = {}
        for i, v, at, number in self.rows:
            best[i] = max(best.get(i, (datetime.min, -1, 0)), (at, number, v))
        return sorted(((i, b[2]) for i, b in best.items()), key=repr)


def test_folds_and_reads_equal_last_write_wins(spark, tmp_path):
    rng, folder, value = random.Random(1), Folder(spark, tmp_path / "t"), 0
    for step in range(7):
        batch = {f"k{rng.randrange(12)}": rng.randrange(step * 10, step * 10 + 60) for _ in range(8)}
        folder.write([(k, (value := value + 1), h) for k, h in batch.items()])
        if step in (1, 3, 4, 6):
            assert folder.fold(buckets=3) > 0
        assert folder.current() == folder.expected()
    assert folder.fold(ended=True) > 0 and folder.fold(ended=True) == 0
    assert folder.current() == folder.expected()
    now = keyed.manifest(spark, folder.target.location)
    assert now.buckets == 3 and now.folded == {"q": 6}
    since = F.lit(T0 + timedelta(hours=40))
    arrived = sinks.read_arrived(spark, folder.target, ["id"], "at", since, SCHEMA)
    assert rows(arrived, "id") == sorted({(i,) for i, _, at, _ in folder.rows if at >= T0 + timedelta(hours=40)})


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    folder = Folder(spark, tmp_path / "t")
    folder.write([(f"k{i}", i, 0) for i in range(40)])
    folder.write([("k1", 100, 1)])
    folder.write([("k2", 200, 24)])
    folder.fold(buckets=4)
    before = keyed.manifest(spark, folder.target.location)
    folder.write([("z", 1, 48)])
    assert folder.fold() == 1
    after = keyed.manifest(spark, folder.target.location)
    changed = {p for p, gen in after.parts.items() if before.parts.get(p) != gen}
    assert len(changed) == 1 and changed.pop().startswith("2024-01-02/")
    assert folder.current() == folder.expected()


def test_a_batch_that_arrives_while_folding_is_read_once(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path / "t")
    folder.write([("a", 1, 0), ("b", 2, 0)])
    folder.write([("a", 3, 1)])
    seen, merge = [], keyed.latest_by_key

    def meanwhile(df, keys, order):
        if not seen:
            seen.append(folder.current())
            folder.write([("b", 4, 2)])
            seen.append(folder.current())
        return merge(df, keys, order)

    monkeypatch.setattr(keyed, "latest_by_key", meanwhile)
    folder.fold()
    assert seen == [[("a", 3), ("b", 2)], [("a", 3), ("b", 4)]]
    assert folder.current() == folder.expected() == [("a", 3), ("b", 4)]
    stored = keyed.stored(spark, folder.target.location, sinks._declared(SCHEMA))
    assert stored.count() == 4


def test_a_crashed_fold_leaves_nothing_and_two_folds_do_not_both_win(spark, tmp_path, monkeypatch):
    folder = Folder(spark, tmp_path / "t")
    for value in range(3):
        folder.write([("a", value, value)])
    real = keyed.Manifest

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed.json, "dumps", crash)
        with pytest.raises(RuntimeError, match="lost"):
            folder.fold()
    assert keyed.manifest(spark, folder.target.location) == real()
    assert folder.current() == [("a", 2)] and folder.fold() == 1 and folder.current() == [("a", 2)]
    folder.write([("a", 9, 9)])
    merge = keyed.latest_by_key

    def other_fold(df, keys, order):
        monkeypatch.setattr(keyed, "latest_by_key", merge)
        folder.fold()
        return merge(df, keys, order)

    monkeypatch.setattr(keyed, "latest_by_key", other_fold)
    with pytest.raises(Exception, match="(?i)exist"):
        folder.fold()
    assert folder.current() == [("a", 9)]


def test_what_is_replaced_goes_one_fold_later(spark, tmp_path):
    folder = Folder(spark, tmp_path / "t")
    for value in range(2):
        folder.write([("a", value, value)])
    folder.fold()
    reader = sinks.read_current(spark, folder.target, ["id"], "at", SCHEMA)
    folder.write([("a", 2, 2)])
    folder.fold()
    assert rows(reader, "v") == [(1,)]
    folder.write([("a", 3, 3)])
    folder.fold()
    folder.write([("a", 4, 4)])
    folder.fold()
    names = [Path(p).name for p in files.children(spark, folder.target.location)]
    assert sorted(n for n in names if n.startswith("batch=")) == [
        f"batch=q-{n:012d}" for n in (2, 3, 4)]
    assert len(files.children(spark, f"{folder.target.location}/_base/manifest")) == keyed.KEEP + 1
    assert folder.current() == folder.expected()


def test_two_queries_and_no_rows(spark, tmp_path):
    folder = Folder(spark, tmp_path / "t")
    assert folder.fold() == 0 and folder.current() == []
    folder.write([("a", 1, 0)], "p")
    folder.write([("a", 2, 0)], "q-7")
    assert folder.fold() == 0
    folder.write([("a", 3, 0)], "q-7")
    assert folder.fold() == 1 and keyed.manifest(spark, folder.target.location).folded == {"q-7": 1}
    assert folder.current() == [("a", 3)]


@pytest.mark.parametrize("folded", [False, True])
def test_newest_rows_need_the_newest_days_only(spark, tmp_path, folded):
    folder = Folder(spark, tmp_path / "t")
    for day in range(12):
        folder.write([(f"k{day}{i}", day, 24 * day + i) for i in range(3)])
        if folded and day in (3, 8):
            folder.fold()
    folder.write([("k00", 100, 24 * 11), ("k10", 101, 24 * 11 + 1)])
    everything = sorted(((at, i, v) for i, (at, _, v) in _best(folder).items()), reverse=True)
    for n, most in ((1, 1), (5, 1), (6, 2), (9, 4), (30, 12), (100, 12)):
        newest = sinks.read_newest(spark, folder.target, ["id"], "at", n, SCHEMA)
        top = newest.orderBy(F.col("at").desc(), F.col("id").desc()).limit(n).collect()
        assert [(r["at"], r["id"], r["v"]) for r in top] == everything[:n]
        read = {p.split("arrival_date=")[1][:10] for p in newest.inputFiles()}
        assert len(read) <= most
    assert sinks.read_newest(spark, Target(str(tmp_path / "none")), ["id"], "at", 3, SCHEMA).count() == 0


def _best(folder):
    best = {}
    for i, v, at, number in folder.rows:
        best[i] = max(best.get(i, (datetime.min, -1, 0)), (at, number, v))
    return best
