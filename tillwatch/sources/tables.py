"""Dimension tables: customers and risk profiles."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.config import DEFAULT_JOIN, JoinPolicy
from tillwatch.operators.joins import measure
from tillwatch.schemas import CUSTOMERS, RISK_PROFILES

log = logging.getLogger(__name__)

RISK_TTL_SECONDS = 60
CUSTOMER_TTL_SECONDS = 3600
MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND")
# Ending of the folder that holds the loads of a table, and the formats loaded that way.
LOADS = "__loads"
PLAIN_FILES = ("parquet", "orc")
GONE = ("FILE_NOT_EXIST", "FileNotFoundException", "PATH_NOT_FOUND")


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder that a catalog table of plain files points to now; None for other formats."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
        F.col("col_name").isin("Provider", "Location")).collect()
    described = {row["col_name"]: row["data_type"] for row in rows}
    return described.get("Location") if described.get("Provider", "").lower() in PLAIN_FILES else None


def table_version(spark: SparkSession, table: str) -> str | None:
    """What changes with each load of a catalog table: where it points to."""
    try:
        return table_location(spark, table)
    except AnalysisException:
        return None


def customer_lines(spark: SparkSession, path: str) -> DataFrame:
    """Customer file with a header row, and ``rejected``: the line, where it has another number
    of fields than the header or no user. Columns are picked by name and text that is not a
    number becomes NULL."""
    reader = spark.read.option("header", "true")
    names = reader.csv(path).columns
    broken = unlike("line", names)
    fields = [T.StructField(name, T.StringType()) for name in [*names, broken]]
    # A line's fields can be counted only if none is left out of the parse.
    text = reader.schema(T.StructType(fields)).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=broken, columnPruning="false").csv(path)
    no_user = F.coalesce(F.trim("user_id"), F.lit("")) == ""
    line = F.coalesce(F.col(broken), F.when(no_user, F.concat_ws(",", *[f"`{n}`" for n in names])))
    return text.select(
        "user_id", "plan",
        *[F.expr(f"try_cast({c} AS DOUBLE)").alias(c) for c in ("avg_amount_30d", "credit_limit")],
        line.alias("rejected"),
    )


def unlike(name: str, names: list[str]) -> str:
    """``name``, made longer until it is none of ``names``."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """The customers of a file, without the lines it rejects."""
    return customer_lines(spark, path).filter("rejected IS NULL").drop("rejected")


def read_table(
    spark: SparkSession, name: str, fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A catalog table, or with ``fmt`` a path or connector table."""
    if fmt is None:
        return spark.read.table(name)
    return spark.read.format(fmt).options(**(options or {})).load(name)


def read_profiles(
    spark: SparkSession, fmt: str, location: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch scan of the serving profile table, typed as the history copy."""
    reader = spark.read.format(fmt).options(**(options or {}))
    table = reader.load(location) if location else reader.load()
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RISK_PROFILES])


def or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """The loaded table, or an empty one when it does not exist. Other errors are raised."""
    try:
        df = load()
        df.schema  # noqa: B018 - analysis happens here, a missing table raises
        return df
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        log.warning("table not found, using an empty one: %s", error.getCondition())
        return spark.createDataFrame([], schema)


def load_customers(spark: SparkSession, table: str, fmt: str | None = None) -> DataFrame:
    """Customer columns used in scoring. A table that does not exist yet gives an empty
    one; any other failure is raised."""
    df = or_empty(spark, lambda: read_table(spark, table, fmt), CUSTOMERS)
    return df.select("user_id", "plan", F.col("avg_amount_30d").cast("double"))


def load_risk(spark: SparkSession, table: str, fmt: str | None = None) -> DataFrame:
    """All columns of the risk profiles; empty when the table does not exist yet."""
    return or_empty(spark, lambda: read_table(spark, table, fmt), RISK_PROFILES)


class Refreshed:
    """A table that long-running queries read anew once it is older than its TTL, or as soon
    as ``version`` says that it points to another load.

    Only the DataFrame (files and plan) and the verdict on its size are held, never its
    rows. When a refresh fails the former copy is kept and the failure is logged.
    """

    def __init__(
        self, load: Callable[[], DataFrame], ttl_seconds: float = RISK_TTL_SECONDS,
        policy: JoinPolicy = DEFAULT_JOIN, clock: Callable[[], float] = time.monotonic,
        version: Callable[[], str | None] = lambda: None,
    ) -> None:
        self._load, self._ttl, self._policy, self._clock = load, ttl_seconds, policy, clock
        self._version = version
        self._df: DataFrame | None = None
        self._small = False
        self._loaded_at = 0.0
        self._loaded: str | None = None

    def get(self) -> DataFrame:
        now, newest = self._clock(), self._version()
        if self._df is None or now - self._loaded_at >= self._ttl or newest != self._loaded:
            try:
                df = self._load()
                self._small = measure(df).fits(self._policy)
                self._df, self._loaded_at, self._loaded = df, now, newest
            except Exception:
                if self._df is None:
                    raise
                log.exception("refresh failed, keeping the former copy")
        return self._df

    def forget(self) -> None:
        """Read the table anew at the next use."""
        self._loaded_at = self._clock() - self._ttl

    def for_users(self, users: DataFrame) -> DataFrame:
        """The rows of ``users``, whose number the caller has checked. A large table is
        cut down next to its scan, without a shuffle."""
        df = self.get()
        return df if self._small else df.join(F.broadcast(users), "user_id", "left_semi")


def is_gone(error: Exception) -> bool:
    """Whether a read failed because files have been replaced since it was planned."""
    return any(sign in str(error) for sign in GONE)
