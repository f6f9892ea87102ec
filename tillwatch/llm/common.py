"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.config import JoinPolicy
from tillwatch.operators.joins import measure

# A side within these limits may be sent to every executor.
SMALL = JoinPolicy(max_broadcast_rows=400_000, max_broadcast_bytes=24 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows that, else unchanged, which
    leaves the join to a shuffle. ``df`` should be cheap to read twice (a written table)."""
    return F.broadcast(df) if measure(df).fits(SMALL) else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores added as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def crc32_of_id(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


_Kept = TypeVar("_Kept")
_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], _Kept]) -> _Kept:
    """What a Python worker keeps between its tasks. There is one place per worker, so that
    operators that run one after the other do not add up in its memory."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Empties that place and gives the freed memory back to the system."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
