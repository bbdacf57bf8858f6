"""Validation of a streaming DataFrame.

Row rules are row-local, so ``validate`` applies to a ``readStream`` frame
unchanged: the OK and KO frames stay streaming (``isStreaming``).  A table-level
``unique`` rule needs a ``Horizon``: keys are then unique within windows of event
time, and rows wait in state until the watermark has passed their window (see
``dqflow.operators.quality``).  Without one it is rejected.

``start_failure_totals`` keeps the failures per rule over all batches: one streaming
aggregate whose state is a counter for each rule, written as a table after every batch.

``start_validated_stream`` runs the split inside ``foreachBatch``: each
micro-batch is persisted once, split, and both halves are written with the
ordinary sink writer.  Every batch lands in ``_versions/<query id>-<batch id>``;
a batch replayed after a failure overwrites its own version, so the output is
exactly-once even though ``foreachBatch`` itself is at-least-once.  The query id
is that of the checkpoint, so streams with different checkpoints never share a
version.  Sinks that are not versioned must overwrite or fail: a replayed batch
would append its rows again.
"""

from __future__ import annotations

import json
from contextlib import contextmanager, nullcontext
from typing import Any, Callable, Iterator, Mapping

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dqflow.errors import InvalidValidationConfig
from dqflow.functions.rules import parse_entry
from dqflow.operators.quality import Horizon, flag_stream_duplicates
from dqflow.operators.validation import ValidationResult, resolve_field, unique_key, validate
from dqflow.sinks.writer import versioning_enabled, write_sink


#: Where rows wait for their window's end: on the executors' disks, under one bounded cache for all stores of an
#: executor, so the heap does not grow with them.
WAITING_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def _flagged(stream_df: DataFrame, rules: Any, horizon: Horizon | None) -> tuple[DataFrame, list[str] | None]:
    """The stream with a verdict column for each of its ``unique`` rules, and their names (None: no such rule)."""
    keys = []
    for block in rules if isinstance(rules, list) else []:
        for entry in (block.get("validations") or []) if isinstance(block, Mapping) else []:
            parsed = parse_entry(entry)
            if parsed.type == "unique" and parsed.enabled:
                keys.append(unique_key(stream_df, resolve_field(stream_df, block.get("field"))[0], parsed.params))
    if not keys:
        return stream_df, None
    if horizon is None:
        raise InvalidValidationConfig("the 'unique' rule needs the whole table; on a stream, give a Horizon (event time, window, delay)")
    flags = [f"__dq_dup_{i}" for i in range(len(keys))]
    return flag_stream_duplicates(stream_df, keys, flags, horizon), flags


def validate_stream(stream_df: DataFrame, rules: Any, *, horizon: Horizon | None = None, **options: Any) -> ValidationResult:
    """Split a streaming frame into streaming OK / KO frames."""
    stream_df, flags = _flagged(stream_df, rules, horizon)
    if options.get("materialize", "none") != "none":
        raise InvalidValidationConfig("a stream cannot be materialized; use start_validated_stream (per batch)")
    return validate(stream_df, rules, flags=flags, **options)


def start_validated_stream(
    stream_df: DataFrame,
    rules: Any,
    ok_sink: Mapping[str, Any],
    ko_sink: Mapping[str, Any],
    *,
    checkpoint_location: str,
    trigger: Mapping[str, Any] | None = None,
    query_name: str | None = None,
    metrics_sink: Mapping[str, Any] | None = None,
    horizon: Horizon | None = None,
    **options: Any,
) -> StreamingQuery:
    """Validate every micro-batch and write OK / KO rows to their sinks.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "1 minute"}``).
    With ``metrics_sink``, each batch also writes its failures per rule
    (``batch_id, rule_index, field, rule, message, failures``), counted by the
    KO write's own scan: no extra pass over the batch.
    """
    stream_df, flags = _flagged(stream_df, rules, horizon)
    _check_sinks(ok_sink, ko_sink, metrics_sink)
    stream_id = _stream_id(checkpoint_location)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            res = validate(batch, rules, observe=metrics_sink is not None, flags=flags, **options)
            run_id = f"{stream_id(batch.sparkSession)}-batch-{batch_id}"
            # OK and KO are independent jobs over the persisted batch: write them side by side.
            write = inheritable_thread_target(batch.sparkSession)(write_sink)
            with ThreadPoolExecutor(max_workers=2) as pool:
                pending = [pool.submit(write, res.ok, ok_sink, run_id=run_id),
                           pool.submit(write, res.ko, ko_sink, run_id=run_id)]
            for f in pending:
                f.result()  # re-raises a failed write
            if metrics_sink is not None:
                failures = res.observed_failures(batch.sparkSession)
                write_sink(failures.select(F.lit(batch_id).cast("long").alias("batch_id"), "*"),
                           metrics_sink, run_id=run_id)
        finally:
            batch.unpersist()

    with _waiting_on_disk(stream_df.sparkSession) if flags else nullcontext():
        return _started(stream_df.writeStream.foreachBatch(each_batch), checkpoint_location, trigger, query_name)


def start_failure_totals(
    stream_df: DataFrame,
    rules: Any,
    sink: Mapping[str, Any],
    *,
    checkpoint_location: str,
    trigger: Mapping[str, Any] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Failures per rule since the stream began (``rule_index, field, rule, message, failures``).

    Each batch is counted by partial aggregates into one state row with a counter for each rule, so totals
    survive restarts with the checkpoint.  Every batch writes them anew: versioned, the latest version is
    the newest total (``keepLast`` drops the older ones); otherwise the sink must overwrite.
    Row rules only: what ``unique`` rejects is final after its window alone, so count it in the rejected rows written.
    """
    _check_sinks(sink)
    totals = validate_stream(stream_df, rules).failures_by_rule()
    stream_id = _stream_id(checkpoint_location)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        write_sink(batch.coalesce(1), sink, run_id=f"{stream_id(batch.sparkSession)}-batch-{batch_id}")

    return _started(totals.writeStream.outputMode("complete").foreachBatch(each_batch), checkpoint_location, trigger, query_name)


def _check_sinks(*sinks: Mapping[str, Any] | None) -> None:
    for sink in filter(None, sinks):
        if str(sink.get("saveMode", "")).lower() == "append" and not versioning_enabled(sink):
            raise InvalidValidationConfig(
                f"sink {sink.get('name', 'unnamed')!r} appends: a replayed batch would be written twice; use versioning")


def _stream_id(checkpoint_location: str) -> Callable[[SparkSession], str]:
    """The id that the checkpoint keeps for its query, over all restarts; read once."""
    held: list[str] = []

    def read(spark: SparkSession) -> str:
        if not held:
            text = spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()[0]
            held.append(json.loads(text)["id"])
        return held[0]

    return read


@contextmanager
def _waiting_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started inside takes ``WAITING_STATE``, unless the session names a provider itself; a checkpoint keeps the one it began with."""
    provider = next(iter(WAITING_STATE))
    held = {k: spark.conf.get(k, None) for k in WAITING_STATE}
    put = {k: v for k, v in WAITING_STATE.items() if held[k] is None} if held[provider] is None else {}
    try:
        for k, v in put.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in put:
            spark.conf.unset(k)


def _started(writer, checkpoint_location: str, trigger: Mapping[str, Any] | None, query_name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
