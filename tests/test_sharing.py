"""One scan for several branches (K12, X2), and counts that leave filters to the scan."""

import os

import pytest
from pyspark.sql import functions as F

from dqflow import register_transform
from dqflow.operators.transforms import StepContext
from dqflow.plans import dataflow
from dqflow.plans.dataflow import build_flow, run

from conftest import SF_SMALL
from test_plans import plan

DDL = "k long, v long, s string"
CHECK = {"name": "check", "type": "validate_fields", "params": {"input": "rows", "validations": [
    {"field": "v", "validations": [{"type": "between", "min": 0, "max": 49}]}, {"field": "s", "validations": ["notEmpty"]}]}}


def document(tmp_path, steps, sinks, fmt="json"):
    return {"dataflows": [{"name": "f", "sources": [{"name": "rows", "format": fmt, "path": str(tmp_path / "in"), "schema": DDL}],
                           "transformations": steps, "sinks": [
                               {"name": n, "input": i, "format": "parquet", "saveMode": "overwrite", "paths": [str(tmp_path / n)]} for n, i in sinks]}]}


@pytest.fixture
def rows(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 100).alias("v"), F.when(F.col("id") % 7 > 0, "x").alias("s"))
    df.repartition(3).write.json(str(tmp_path / "in"))
    df.write.parquet(str(tmp_path / "columnar"))
    return df


def read_only_once(monkeypatch, tmp_path):
    """The source's files are gone once the first sink is written: a second scan would fail."""
    write, calls = dataflow.write_sink, []

    def once(df, sink, **kw):
        out = write(df, sink, **kw)
        if not calls:
            for name in os.listdir(tmp_path / "in"):
                os.remove(tmp_path / "in" / name)
        calls.append(sink["name"])
        return out

    monkeypatch.setattr(dataflow, "write_sink", once)
    return calls


def test_accepted_and_rejected_rows_from_one_scan(spark, rows, tmp_path, monkeypatch):
    calls = read_only_once(monkeypatch, tmp_path)
    doc = document(tmp_path, [CHECK], [("ok", "validation_ok"), ("ko", "check_ko"), ("failures", "check_failures")])
    flow = run(spark, doc, run_id="r").flow()
    assert sorted(calls) == ["failures", "ko", "ok"] and list(flow.stored) == ["check"]
    good = rows.where("v <= 49 AND s = 'x'")
    ok, ko = spark.read.parquet(str(tmp_path / "ok")), spark.read.parquet(str(tmp_path / "ko"))
    assert sorted(ok.collect()) == sorted(good.collect()) and ok.columns == ["k", "v", "s"]
    assert ko.count() == 400 - good.count() and set(ko.columns) == {"k", "v", "s", "validation_errors", "validation_errors_text"}
    failures = {r.rule: r.failures for r in spark.read.parquet(str(tmp_path / "failures")).collect()}
    assert failures == {"between": rows.where("v > 49").count(), "notEmpty": rows.where("s IS NULL").count()}
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # nothing stays stored


def test_branches_of_a_step_from_one_scan(spark, rows, tmp_path, monkeypatch):
    calls = read_only_once(monkeypatch, tmp_path)
    steps = [{"name": "twice", "type": "derive_column", "params": {"input": "rows", "column": "w", "expression": "v * 2"}},
             {"name": "low", "type": "filter_rows", "params": {"input": "twice", "condition": "w < 50"}},
             {"name": "high", "type": "filter_rows", "params": {"input": "twice", "condition": "w >= 50"}}]
    flow = run(spark, document(tmp_path, steps, [("a", "low"), ("b", "high"), ("c", "twice")]), run_id="r").flow()
    assert list(flow.stored) == ["twice"] and len(calls) == 3
    counts = [spark.read.parquet(str(tmp_path / n)).count() for n in "abc"]
    assert counts == [100, 300, 400]


def test_what_is_cheap_is_read_again(spark, rows, tmp_path):
    """Branches over a columnar source keep their own pushed filters; a single branch is never stored."""
    doc = document(tmp_path, [CHECK], [("ok", "check_ok"), ("ko", "check_ko")], "parquet")
    doc["dataflows"][0]["sources"][0]["path"] = str(tmp_path / "columnar")
    flow = build_flow(spark, doc["dataflows"][0], StepContext(), share="auto")
    assert not flow.stored and "PushedFilters: [Is" in plan(flow.tables["check_ok"])
    one = document(tmp_path, [CHECK], [("ok", "check_ok")])
    assert not build_flow(spark, one["dataflows"][0], StepContext(), share="auto").stored


def test_a_users_step_is_stored_if_it_shuffles(spark, rows, tmp_path):
    register_transform("sums_per_s", lambda df, params, ctx: df.groupBy("s").agg(F.sum("v").alias("v")))
    register_transform("one_more", lambda df, params, ctx: df.withColumn("v", F.col("v") + 1))
    for kind, kept in (("sums_per_s", ["own"]), ("one_more", [])):
        steps = [{"name": "own", "type": kind, "params": {"input": "rows"}},
                 *[{"name": n, "type": "filter_rows", "params": {"input": "own", "condition": f"v > {n[1]}"}} for n in ("b1", "b2")]]
        doc = document(tmp_path, steps, [("x", "b1"), ("y", "b2")], "parquet")
        doc["dataflows"][0]["sources"][0]["path"] = str(tmp_path / "columnar")
        flow = build_flow(spark, doc["dataflows"][0], StepContext(), share="auto")
        assert list(flow.stored) == kept
        flow.release()


def test_counted_sources_keep_their_pushed_filters(spark, tmp_path):
    doc = {"dataflows": [{"name": "r", "sources": [{"name": "orders", "format": "parquet", "path": f"{SF_SMALL}/orders.parquet"}],
                          "transformations": [{"name": "done", "type": "filter_rows", "params": {"input": "orders", "condition": "o_orderstatus = 'F'"}}],
                          "sinks": [{"name": "s", "input": "done", "format": "parquet", "saveMode": "overwrite", "paths": [str(tmp_path / "s")]}]}]}
    flow = build_flow(spark, doc["dataflows"][0], StepContext(), observe_tables=True)
    assert "EqualTo(o_orderstatus,F)" in plan(flow.tables["done"])
    table = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    report = {r.name: r.rows for r in run(spark, doc, run_id="r", observe_tables=True).report(spark).collect()}
    finished = table.where("o_orderstatus = 'F'").count()
    assert report == {"orders": table.count(), "done": finished, "s": finished}
