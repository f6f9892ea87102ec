"""Compaction of history tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.sources.files import children, delete, exists, move

TARGET_BYTES = 134_217_728
# Hidden from readers by its first letter.
WORK = "_compaction"
PARTITIONS_PER_RUN = 366


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified_at, bytes) of every data file below a folder. The content column
    is not selected, so no file is opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "[!._]*").load(path)
        .select("path", F.col("modificationTime").alias("modified_at"),
                F.col("length").alias("bytes"))
    )


def partition_files(listing: DataFrame, column: str) -> DataFrame:
    """Files and bytes of each partition folder ``column=value``."""
    value = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    return listing.groupBy(value.alias(column)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def partitions_to_compact(
    listing: DataFrame, column: str, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Partitions that hold more files than their bytes need, with the needed number."""
    needed = F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)), F.lit(1)).cast("int")
    return (
        partition_files(listing, column).withColumn("needed", needed)
        .filter(F.col("files") > F.col("needed"))
    )


def compact(
    spark: SparkSession,
    path: str,
    column: str = "event_date",
    sort_by: tuple[str, ...] = ("event_time",),
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Rewrite the small files of a table partitioned by ``column`` alone into files of about
    ``target_bytes``; returns the number of partitions rewritten.

    Each partition gets as many tasks as it needs files, and its rows are dealt to them
    by hash, so a partition that holds most of the table is written by many tasks. The new
    files are written beside the table and compared with the rows of exactly the listed files.
    Then a journal of what goes and what comes is written, the new files are moved in, and the
    listed files are deleted, never any other: what a writer adds meanwhile stays. After a
    crash the next run finishes what a journal describes. Plain files have no transactions:
    between moving and deleting a reader can see both copies. Partitions are taken in runs of
    at most ``PARTITIONS_PER_RUN`` until none is left.
    """
    for journal in children(spark, f"{path}/{WORK}"):
        _finish(spark, journal)
    done = ""
    rewritten = 0
    while True:
        listing = list_files(spark, path)
        _check_layout(listing, path, column)
        todo = partitions_to_compact(listing, column, target_bytes)
        run = todo.filter(F.col(column) > done).orderBy(column).limit(PARTITIONS_PER_RUN).collect()
        if not run:
            return rewritten
        names = [row[column] for row in run]
        in_run = F.regexp_extract("path", f"/{column}=([^/]+)/", 1).isin(names)
        files = [row["path"] for row in listing.filter(in_run).select("path").collect()]
        old = spark.read.option("basePath", path).parquet(*files)
        work = f"{path}/{WORK}/{uuid.uuid4().hex}"
        (
            _dealt(spark, old, column, {row[column]: row["needed"] for row in run})
            .sortWithinPartitions(column, *[c for c in sort_by if c in old.columns])
            .write.partitionBy(column).parquet(f"{work}/new")
        )
        new = spark.read.schema(old.schema).parquet(f"{work}/new")
        if fingerprint(new) != fingerprint(old):
            delete(spark, work)
            raise RuntimeError("rewritten rows differ from the table, nothing was replaced")
        moves = [(row["path"], path + row["path"].split(f"{work}/new", 1)[1])
                 for row in list_files(spark, f"{work}/new").collect()]
        spark.createDataFrame(
            [("move", *move) for move in moves] + [("delete", file, None) for file in files],
            "what string, file string, target string",
        ).coalesce(1).write.parquet(f"{work}/journal")
        _finish(spark, work)
        spark.catalog.refreshByPath(path)
        rewritten += len(run)
        done = run[-1][column]


def _check_layout(listing: DataFrame, path: str, column: str) -> None:
    """Refuse a table with other folders than ``column=value``: files put back by this column
    alone would leave the layout, and the table could not be read any more."""
    folders = F.regexp_extract("path", r"((?:/[^/=]+=[^/]+)*)/[^/]+$", 1)
    odd = listing.filter(~folders.rlike(f"^/{column}=[^/]+$")).first()
    if odd is not None:
        raise ValueError(f"{path} is not partitioned by {column} alone: {odd['path']}")


def _finish(spark: SparkSession, work: str) -> None:
    """Carry out a journal; every step may have been done already. Work without a whole
    journal has changed nothing yet and is dropped."""
    if exists(spark, f"{work}/journal/_SUCCESS"):
        steps = spark.read.parquet(f"{work}/journal").collect()
        for step in steps:
            if step["what"] == "move":
                move(spark, step["file"], step["target"])
        for step in steps:
            if step["what"] == "delete":
                delete(spark, step["file"])
    delete(spark, work)


def _partition_text(column: str) -> Column:
    """The partition value as it stands in the folder name."""
    return F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))


def _dealt(spark: SparkSession, df: DataFrame, column: str, needed: dict[str, int]) -> DataFrame:
    """Rows dealt to tasks: ``needed[value]`` tasks for the rows of each partition value."""
    firsts, tasks = [], 0
    for value, count in needed.items():
        firsts.append((value, tasks, count))
        tasks += count
    places = spark.createDataFrame(firsts, "_value string, _first int, _count int")
    dealt = F.col("_first") + F.pmod(F.xxhash64(*df.columns), F.col("_count")).cast("int")
    return (
        df.withColumn("_value", _partition_text(column))
        .join(F.broadcast(places), "_value")
        .repartitionById(tasks, dealt)
        .select(*df.columns)
    )


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free sum of row hashes: equal for equal multisets."""
    columns = sorted(df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)
