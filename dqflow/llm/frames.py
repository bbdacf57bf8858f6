"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes that Spark sends to a Python worker at once, unless the session has a number of its own.
ARROW_BYTES = 8 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def kept(df: DataFrame, *replaced: str) -> list[Column]:
    """The columns of ``df`` but those an operator replaces (names compare as Spark's do)."""
    gone = {n.lower() for n in replaced}
    return [col(n) for n in df.columns if n.lower() not in gone]


def give_back() -> None:
    """Return memory that Python and Arrow hold and no longer use to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # glibc's
        trim(0)


def in_task(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; at its end a task gives back what it no longer uses, as Spark keeps
    Python workers, several a core, for later tasks: what they held at most would add up."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within send rows to Python some ``ARROW_BYTES`` at a time: Spark builds each Arrow
    batch beside its heap, and Python holds it again.  A session that sets this itself keeps its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(ARROW_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key)


def with_arrow_columns(df: DataFrame, added: str, make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, made per Arrow batch; same-named columns give way."""
    new = StructType.fromDDL(added)
    base = df.select(*kept(df, *new.names))
    names = [*base.columns, *new.names]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], names)

    return base.mapInArrow(in_task(run), StructType([*base.schema.fields, *new.fields]))
