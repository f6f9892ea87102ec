"""Left join of a fact table to a table with one row per key.

The small side is broadcast only after its rows and bytes have been counted. A side
over the limits is joined by shuffle, where the keys that hold most of the facts are
spread over salts so that no task receives a whole hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.config import DEFAULT_JOIN, JoinPolicy
from tillwatch.schemas import MESSAGE_KEY

# Facts without a key need no partner, so any large number spreads them.
NULL_SALTS = 1 << 20


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, policy: JoinPolicy) -> bool:
        return self.rows <= policy.max_broadcast_rows and self.bytes <= policy.max_broadcast_bytes


def _row_bytes(schema: T.StructType) -> Column:
    """Approximate width of one row: 16 bytes per column plus the length of texts and what
    nested columns hold."""
    sizes = [_held_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema]
    total = F.lit(16 * len(schema)).cast("long")
    for size in sizes:
        total = total + size if size is not None else total
    return total


def _held_bytes(value: Column, kind: T.DataType) -> Column | None:
    """Bytes of a value beyond its own 16; None if it never has any."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        number = F.coalesce(F.greatest(F.size(value), F.lit(0)), F.lit(0)).cast("long") * 16
        if _held_bytes(F.lit(None), kind.elementType) is None:
            return number
        held = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _held_bytes(x, kind.elementType))
        return number + F.coalesce(held, F.lit(0).cast("long"))
    if isinstance(kind, T.MapType):
        keys = _held_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _held_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        total = F.lit(16 * len(kind)).cast("long")
        for f in kind:
            size = _held_bytes(value.getField(f.name), f.dataType)
            total = total + size if size is not None else total
        return total
    return None


def measure(df: DataFrame) -> Size:
    """Rows and approximate bytes, in one aggregation that combines map-side."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df.schema)).alias("bytes")
    ).first()
    return Size(row["rows"], row["bytes"] or 0)


def latest_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest row of each key. Spark keeps one row per key and task before the
    shuffle (window group limit), so the copies of a hot key are not shuffled."""
    newest = Window.partitionBy(*keys).orderBy(*[_descending(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def _descending(column: str | Column) -> Column:
    return F.col(column).desc_nulls_last() if isinstance(column, str) else column


def hot_keys(facts: DataFrame, keys: list[str], policy: JoinPolicy = DEFAULT_JOIN) -> DataFrame:
    """The heaviest keys with at least ``policy.hot_rows`` facts, never more than
    ``policy.hot_keys`` of them, with the number of salts each gets."""
    return (
        facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= policy.hot_rows)
        .orderBy(F.col("_n").desc(), *keys)
        .limit(policy.hot_keys)
        .select(*keys, F.ceil(F.col("_n") / F.lit(policy.hot_rows)).cast("int").alias("_salts"))
    )


def _spread_over(facts: DataFrame) -> list[str]:
    """Columns that tell the facts of one key apart: the message identity where there is
    one, so that no other column has to be read for the salt."""
    identity = [c for c in MESSAGE_KEY if c in facts.columns]
    return identity if len(identity) == len(MESSAGE_KEY) else facts.columns


def salted_left_join(
    facts: DataFrame, unique: DataFrame, keys: list[str], policy: JoinPolicy = DEFAULT_JOIN
) -> DataFrame:
    """Shuffled left join with the hot keys spread. Only the rows of hot keys are
    repeated on the unique side, once per salt. Facts with a NULL key match nothing
    and are spread over all tasks."""
    hot = F.broadcast(hot_keys(facts, keys, policy))
    no_key = F.expr(" OR ".join(f"{key} IS NULL" for key in keys))
    salts = F.when(no_key, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = (
        facts.join(hot, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*_spread_over(facts)), salts).cast("int"))
        .drop("_salts")
    )
    repeated = (
        unique.join(hot, keys, "left")
        .withColumn("_salt", F.expr("explode(sequence(0, coalesce(_salts, 1) - 1))"))
        .drop("_salts")
    )
    return spread.join(repeated, [*keys, "_salt"], "left").drop("_salt")


def left_join_unique(
    facts: DataFrame,
    unique: DataFrame,
    keys: list[str],
    policy: JoinPolicy = DEFAULT_JOIN,
    size: Size | None = None,
) -> DataFrame:
    """Keep every fact and add the columns of ``unique``, which has at most one row per
    key. ``size`` saves the count when the caller has measured that side already."""
    size = measure(unique) if size is None else size
    if size.fits(policy):
        return facts.join(F.broadcast(unique), keys, "left")
    return salted_left_join(facts, unique, keys, policy)
