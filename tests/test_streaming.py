"""Validation on a stream (file source, availableNow trigger)."""

import pytest
from pyspark.sql import functions as F

from dqflow import InvalidValidationConfig, validate
from dqflow.sinks.writer import list_versions, read_latest, read_versions
from dqflow.streaming import Horizon, start_failure_totals, start_validated_stream, validate_stream

from conftest import SF_SMALL

RULES = [{"field": "o_totalprice", "validations": [{"type": "greaterThan", "value": 100000}]}]


def _stream(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/orders.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(SF_SMALL)


def test_stream_split_stays_streaming(spark):
    res = validate_stream(_stream(spark), RULES)
    assert res.ok.isStreaming and res.ko.isStreaming
    with pytest.raises(InvalidValidationConfig):
        validate_stream(_stream(spark), [{"field": "o_orderkey", "validations": ["unique"]}])
    disabled = [{"field": "o_orderkey", "validations": [{"type": "unique", "enabled": False}, "notNull"]}]
    assert validate_stream(_stream(spark), disabled).ok.isStreaming


def test_foreach_batch_versions(spark, tmp_path):
    base = str(tmp_path)
    ok = {"name": "ok", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/ok"], "versioning": True}
    ko = {"name": "ko", "format": "json", "saveMode": "overwrite", "paths": [f"{base}/ko"], "versioning": True}
    q = start_validated_stream(_stream(spark), RULES, ok, ko, checkpoint_location=f"{base}/ckpt",
                               trigger={"availableNow": True})
    q.awaitTermination()
    total = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    n_ok = read_versions(spark, f"{base}/ok").count()
    n_ko = read_versions(spark, f"{base}/ko").count()
    assert n_ok == total.filter("o_totalprice > 100000").count()
    assert n_ok + n_ko == total.count()
    # restarting from the checkpoint processes nothing new
    q2 = start_validated_stream(_stream(spark), RULES, ok, ko, checkpoint_location=f"{base}/ckpt",
                                trigger={"availableNow": True})
    q2.awaitTermination()
    assert read_versions(spark, f"{base}/ok").count() == n_ok


def test_per_batch_failure_metrics(spark, tmp_path):
    base = str(tmp_path)
    ok = {"name": "ok", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/ok"], "versioning": True}
    ko = {"name": "ko", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/ko"], "versioning": True}
    metrics = {"name": "m", "format": "json", "saveMode": "overwrite", "paths": [f"{base}/metrics"], "versioning": True}
    q = start_validated_stream(_stream(spark), RULES, ok, ko, checkpoint_location=f"{base}/ckpt",
                               trigger={"availableNow": True}, metrics_sink=metrics)
    q.awaitTermination()
    m = read_versions(spark, f"{base}/metrics").collect()
    total = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert [(r.batch_id, r.rule) for r in m] == [(0, "greaterThan")]
    assert m[0].failures == total.filter("NOT (o_totalprice > 100000)").count()


def test_two_streams_into_one_base(spark, tmp_path):
    """Batch ids start again with each checkpoint; the versions of the two streams stay apart."""
    base = str(tmp_path)
    ok = {"name": "ok", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/ok"], "versioning": True}
    ko = {"name": "ko", "format": "json", "saveMode": "overwrite", "paths": [f"{base}/ko"], "versioning": True}
    for k in (1, 2):
        start_validated_stream(_stream(spark), RULES, ok, ko, checkpoint_location=f"{base}/ckpt{k}", trigger={"availableNow": True}).awaitTermination()
    total = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    both = read_versions(spark, f"{base}/ok").unionByName(read_versions(spark, f"{base}/ko"), allowMissingColumns=True)
    assert both.count() == 2 * total and both.select("version_id").distinct().count() == 2


def test_appending_sinks_are_rejected(spark, tmp_path):
    sink = {"name": "a", "format": "parquet", "saveMode": "APPEND", "paths": [str(tmp_path / "a")]}
    with pytest.raises(InvalidValidationConfig):
        start_validated_stream(_stream(spark), RULES, sink, sink, checkpoint_location=str(tmp_path / "c"))


# ---------------------------------------------------------------------------
# Uniqueness and totals over micro-batches
# ---------------------------------------------------------------------------

EVENTS = [  # (id, key, other, minute), in the order of their files
    [(1, "a", "x", 0), (2, "b", "x", 1), (3, None, "x", 2), (4, "a", "y", 30)],
    [(5, "a", "x", 59), (6, "c", "y", 61), (7, "c", "z", 62), (8, "d", "z", 70)],
    [(9, "d", "z", 119), (10, "a", "x", 121), (11, "b", None, 125)],
    [(12, None, None, 10_000), (13, "q", "w", None)],
]
EVENT_DDL = "id long, key string, other string, at timestamp"


def _events(spark, path):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    for rows in EVENTS:
        made = [(i, k, o, None if m is None else start + dt.timedelta(minutes=m)) for i, k, o, m in rows]
        spark.createDataFrame(made, EVENT_DDL).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT_DDL).option("maxFilesPerTrigger", 1).parquet(path)


def _sinks(base):
    return [{"name": n, "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/{n}"], "versioning": True} for n in ("ok", "ko")]


@pytest.mark.parametrize("rules", [
    [{"field": "key", "validations": ["unique"]}],
    [{"field": "key", "validations": [{"type": "unique", "fields": ["key", "other"]}, "notNull"]}, {"field": "other", "validations": ["notNull"]}],
    [{"field": "key", "validations": ["unique"]}, {"field": "other", "validations": ["unique"]}]])
def test_unique_within_windows_equals_the_batch_verdict(spark, tmp_path, rules):
    base = str(tmp_path)
    q = start_validated_stream(_events(spark, f"{base}/in"), rules, *_sinks(base), checkpoint_location=f"{base}/ckpt",
                               trigger={"availableNow": True}, horizon=Horizon("at", "1 hour", "5 minutes", salts=3))
    q.awaitTermination()
    got = {r.id: "" for r in read_versions(spark, f"{base}/ok").collect()}
    ko = read_versions(spark, f"{base}/ko")
    got.update({r.id: r.validation_errors_text for r in ko.collect()})
    want = {}
    rows = spark.read.parquet(f"{base}/in").where("id < 12").withColumn("hour", F.date_trunc("hour", "at"))
    for hour in [r.hour for r in rows.select("hour").distinct().collect()]:  # the batch verdict, window by window
        res = validate(rows.where(F.col("hour") == F.lit(hour)).drop("hour"), rules)
        want.update({r.id: "" for r in res.ok.collect()})
        want.update({r.id: r.validation_errors_text for r in res.ko.collect()})
    assert "unique" in got.pop(13)  # no event time, no window
    assert got == want and len(got) == 11
    assert [c for c in ko.columns if c.startswith("__")] == []


def test_totals_equal_failures_by_rule(spark, tmp_path):
    base = str(tmp_path)
    rules = [{"field": "key", "validations": ["notNull", {"type": "inList", "values": ["a", "b"], "message": "other key"}]}, {"field": "other", "validations": ["notNull"]}]
    sink = {"name": "t", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/totals"], "versioning": {"enabled": True, "keepLast": 2}}
    stream = _events(spark, f"{base}/in")
    for _ in range(2):  # a restart adds nothing
        start_failure_totals(stream, rules, sink, checkpoint_location=f"{base}/ckpt", trigger={"availableNow": True}).awaitTermination()
    want = validate(spark.read.parquet(f"{base}/in"), rules).failures_by_rule().collect()
    assert sorted(read_latest(spark, f"{base}/totals").drop("version_id").collect()) == sorted(want)
    assert list_versions(spark, f"{base}/totals").count() == 2
    with pytest.raises(InvalidValidationConfig):
        start_failure_totals(stream, [{"field": "key", "validations": ["unique"]}], sink, checkpoint_location=f"{base}/c2")


def test_composite_keys(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("x", "y"), ("x", "y"), (None, "y"), ("x", None)], "p string, q string")
    res = validate(df, [{"field": "p", "validations": [{"type": "unique", "fields": ["p", "q"]}]}])
    assert sorted(map(tuple, res.ok.collect())) == [("a", "b:c"), ("a:b", "c")] and res.ko.count() == 4
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 1)], "d double, i int")
    assert validate(zeros, [{"field": "d", "validations": [{"type": "unique", "fields": ["d", "i"]}]}]).ok.count() == 0
    with pytest.raises(InvalidValidationConfig):
        validate(df, [{"field": "p", "validations": [{"type": "unique", "fields": []}]}])


def test_rows_waiting_for_their_window_lie_outside_the_heap(spark, tmp_path):
    """A stream with a horizon keeps its state in RocksDB; the session's own settings stay, and a provider it names is taken."""
    base, key = str(tmp_path), "spark.sql.streaming.stateStore.providerClass"
    stream, before = _events(spark, f"{base}/in"), spark.conf.get(key, None)
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    for name, given, want in (("a", None, "RocksDBStateStoreProvider"), ("b", own, own)):
        if given:
            spark.conf.set(key, given)
        try:
            start_validated_stream(stream, [{"field": "key", "validations": ["unique"]}], *_sinks(f"{base}/{name}"), checkpoint_location=f"{base}/{name}/ckpt",
                                   trigger={"availableNow": True}, horizon=Horizon("at", "1 hour", "5 minutes", salts=2)).awaitTermination()
            assert spark.conf.get(key, None) == (given or before)
        finally:
            spark.conf.unset(key)
        assert want in (tmp_path / name / "ckpt" / "offsets" / "0").read_text()
