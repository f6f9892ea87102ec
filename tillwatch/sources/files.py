"""Names of files and folders, in whatever store the session can reach. Only names pass the
driver, never content."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Full names of what lies in a folder; none if it does not exist."""
    store, target = _store(spark, path)
    return [str(s.getPath()) for s in store.listStatus(target)] if store.exists(target) else []


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within one store. False if the source is gone or the target is there."""
    store, old = _store(spark, source)
    _, new = _store(spark, target)
    if not store.exists(old) or store.exists(new):
        return False
    store.mkdirs(new.getParent())
    return store.rename(old, new)


def delete(spark: SparkSession, path: str) -> None:
    store, target = _store(spark, path)
    store.delete(target, True)
