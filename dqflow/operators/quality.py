"""Table-level quality operators that need an aggregation.

``flag_duplicates`` marks every row whose key occurs more than once.  Plan:

1. ``groupBy(key).count()`` with map-side partial aggregation, so a hot key
   costs one partial row per input task, not one shuffled row per input row.
2. The duplicated keys are joined back with a shuffle join on
   ``(key, salt)``.  Every key with more than ``rows_per_salt`` rows gets
   ``ceil(count / rows_per_salt)`` salts, so no join task receives more than
   about ``rows_per_salt`` rows of one key, however many such keys there are.
   ``(key hash, salts)`` of these keys are broadcast.  ``rows_per_salt`` is
   raised to ``total rows / HOT_KEYS`` where that is more, so the broadcast
   holds fewer than ``HOT_KEYS`` pairs of numbers at any size of the table, and
   a key below it is at most one in ``HOT_KEYS`` of all rows.
   Rows of a hot key spread over its salts; the key's single "duplicated" mark
   is replicated once per salt; every other key keeps salt 0.  Both sides look
   up the same hash, so a hash collision merely salts one more key, and the
   result does not depend on the salt a row gets: the plan stays exact, also
   when a task is retried.
3. Rows with a NULL key match nothing; they are spread over ``NULL_SALTS``.

No key group is ever collected into one task or to the driver.

``flag_stream_duplicates`` does the same for a stream: a key is duplicated if it
occurs more than once in one event-time window.  Keys are counted per window by a
streaming aggregate, and the rows wait in the state of a stream-stream join until the
watermark has passed their window's end, so each row is given its final verdict
once.  Rows of a key are spread over salts in that state; counts of duplicated keys
alone are replicated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_SALT = 1_000_000
HOT_KEYS = 100_000
NULL_SALTS = 4096


def flag_duplicates(
    df: DataFrame,
    key: Column,
    flag: str,
    *,
    counted: DataFrame | None = None,
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
) -> DataFrame:
    """Append boolean ``flag``: the non-null ``key`` appears on more than one row
    of ``counted`` (by default of ``df`` itself; ``df`` may be a filtered part of it)."""
    if rows_per_salt < 1:
        raise ValueError("rows_per_salt is at least 1")
    k, n, salt, salts, h = "__dq_key", "__dq_n", "__dq_salt", "__dq_salts", "__dq_hash"
    keyed = df.withColumn(k, key)
    counts = (
        (df if counted is None else counted).select(key.alias(k))
        .where(F.col(k).isNotNull())
        .groupBy(k)
        .agg(F.count(F.lit(1)).alias(n))
    )
    # A stage of its own: with its size known, Spark joins a small set of keys by broadcast and
    # the rows are not shuffled.  They wait for it, as ``hot`` is made from it.
    dups = counts.where(F.col(n) > 1).repartition(F.col(k))
    # Grouping and joins treat -0.0 and 0.0 as one key; hash them as one too.
    key_type = keyed.schema[k].dataType
    hashed = F.xxhash64(F.col(k) + F.lit(0.0) if isinstance(key_type, (T.FloatType, T.DoubleType)) else F.col(k))
    # Rows under a duplicated key are as many as matter: fewer than HOT_KEYS keys can hold more than this share of them.
    share = dups.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).select(
        F.greatest(F.lit(rows_per_salt).cast("long"), F.ceil(F.col("total") / HOT_KEYS)).alias("share"))
    per_salt = share.scalar()
    hot = (
        dups.where(F.col(n) > per_salt)
        .select(hashed.alias(h), F.ceil(F.col(n) / per_salt).cast("int").alias(salts))
        .groupBy(h).agg(F.sum(salts).cast("int").alias(salts))
    )

    def with_salts(frame: DataFrame) -> DataFrame:
        return (frame.withColumn(h, hashed).join(F.broadcast(hot), on=h, how="left").drop(h)
                .withColumn(salts, F.coalesce(F.col(salts), F.lit(1))))

    spread = F.when(F.col(k).isNull(), F.lit(NULL_SALTS)).otherwise(F.col(salts))
    big = with_salts(keyed).withColumn(
        salt, F.pmod(F.monotonically_increasing_id(), spread).cast("int")
    ).drop(salts)
    marks = with_salts(dups).select(
        k,
        F.explode(F.sequence(F.lit(0), F.col(salts) - 1)).alias(salt),
        F.lit(True).alias(flag),
    )
    joined = big.join(marks, on=[k, salt], how="left").drop(salt)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop(k)


@dataclass(frozen=True)
class Horizon:
    """How far uniqueness reaches on a stream: windows of ``window`` over the column ``event_time``, whose rows
    come at most ``delay`` late; later ones are dropped by Spark and counted in the query's progress."""

    event_time: str
    window: str
    delay: str
    salts: int = 8


def flag_stream_duplicates(stream: DataFrame, keys: list[Column], flags: list[str], horizon: Horizon) -> DataFrame:
    """Append a boolean for each of ``keys``: the non-null key is on more than one row of the row's window."""
    k, w, salt, time = "__dq_key", "__dq_window", "__dq_salt", "`" + horizon.event_time.replace("`", "``") + "`"
    source = stream.withWatermark(horizon.event_time, horizon.delay)
    rows = source.withColumn(w, F.window(F.col(time), horizon.window))
    # A stream carries one event time; from here on it is the window.
    rows = rows.withColumn(horizon.event_time, F.col(time) + F.expr("INTERVAL 0 SECOND"))
    rows = rows.withColumn(salt, F.floor(F.rand(7) * horizon.salts).cast("int"))
    for key, flag in zip(keys, flags, strict=True):
        counts = (
            source.select(key.alias(k), F.window(F.col(time), horizon.window).alias(w)).where(F.col(k).isNotNull())
            .groupBy(k, w).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col(k).alias("right_key"), F.col(w).alias("right_window"),
                    F.explode(F.sequence(F.lit(0), F.lit(horizon.salts - 1))).alias("right_salt"), F.lit(True).alias(flag))
        )
        met = (F.col(k) == F.col("right_key")) & (F.col(w) == F.col("right_window")) & (F.col(salt) == F.col("right_salt"))
        kept = [c for c in rows.columns]
        rows = rows.withColumn(k, key).join(counts, met, "left_outer").select(*[F.col("`" + c.replace("`", "``") + "`") for c in kept], F.coalesce(F.col(flag), F.lit(False)).alias(flag))
    # A row without an event time lies in no window: nothing says that its key is unique.
    timeless = stream.where(F.col(time).isNull()).withColumns({flag: F.lit(True) for flag in flags})
    return rows.drop(w, salt).unionByName(timeless)
