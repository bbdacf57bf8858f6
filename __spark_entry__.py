"""

Every query runs the library (``dqflow``) over whole driver tables (or the
``contacts`` view Spark derives from ``customer``).  Every oracle is
hand-written DuckDB SQL over the same tables; column names match.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from functools import partial

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqflow import apply_transform, validate
from dqflow.plans.dataflow import build_flow, run
from dqflow.errors import SinkError
from dqflow.operators.transforms import StepContext, register_transform
from dqflow.plans.workloads import CONTACT_RULES, SINGLE_RULES, contacts, single_rule
from dqflow.session import scratch_path
from dqflow.sinks.writer import list_versions, read_latest, read_version, read_versions, write_sink
from dqflow.sources.inventory import check_sources, source_inventory
from dqflow.sources.reader import read_source, read_table

SMOKE_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _steps(df: DataFrame, *steps: tuple[str, dict]) -> DataFrame:
    ctx = StepContext(run_id="q")
    for stype, params in steps:
        df = apply_transform(stype, df, params, ctx)
    return df


# ---------------------------------------------------------------------------
# Flagship (entry) and validation queries on the contacts view
# ---------------------------------------------------------------------------

def _validate_ko_text(spark, sf, rules=CONTACT_RULES, **opts):
    ko = validate(contacts(spark, sf), rules, **opts).ko
    return ko.select("id", "validation_errors_text")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: validate the contacts view with the full rule set; rejected rows + report."""
    return _validate_ko_text(spark, SMOKE_DIR)


def q_rule(rule: str, spark, sf):
    return validate(contacts(spark, sf), single_rule(rule)).ok.select("id")


def q_validate_ok(spark, sf):
    return validate(contacts(spark, sf), CONTACT_RULES).ok.select("id")


def q_validate_ko_map(spark, sf):
    ko = validate(contacts(spark, sf), CONTACT_RULES).ko
    entries = F.array_sort(F.map_entries("validation_errors"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), "|")
    return ko.select("id", text.alias("errors_map_text"))


def q_validate_ko_array(spark, sf):
    ko = validate(contacts(spark, sf), CONTACT_RULES, keep_array=True).ko
    return ko.select(
        "id",
        F.size("validation_errors_array").cast("bigint").alias("n_errors"),
        F.array_join("validation_errors_array", " | ").alias("errors_joined"),
    )


def q_validate_truncated(spark, sf):
    ko = validate(contacts(spark, sf), CONTACT_RULES, max_errors_per_row=2, max_errors_per_field=1).ko
    entries = F.array_sort(F.map_entries("validation_errors"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), "|")
    return ko.select("id", "validation_errors_text", text.alias("errors_map_text"))


PRECEDENCE_RULES = [
    {"field": "email", "message": "email block message", "validations": [
        "email", {"type": "endsWith", "suffix": "@example.com", "message": "email must end in @example.com"}]},
    {"field": "phone", "validations": ["phone", {"type": "startsWith", "prefix": "+1"}]},
]


def q_validate_precedence(spark, sf):
    return _validate_ko_text(spark, sf, PRECEDENCE_RULES)


SAME_FIELD_RULES = [
    {"field": "name", "validations": ["notNull"]},
    {"field": "status", "validations": [{"type": "equals", "value": "ACTIVE"}]},
    {"field": "name", "message": "name needs 2+ chars", "validations": [{"type": "minLength", "value": 2}]},
]


def q_validate_same_field(spark, sf):
    ko = validate(contacts(spark, sf), SAME_FIELD_RULES).ko
    entries = F.array_sort(F.map_entries("validation_errors"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), "|")
    return ko.select("id", "validation_errors_text", text.alias("errors_map_text"))


def q_validate_annotated(spark, sf):
    """Every row flagged in one pass (write it partitioned by is_valid for a one-scan split)."""
    every = validate(contacts(spark, sf), CONTACT_RULES).annotated()
    return every.select("id", "is_valid", "validation_errors_text")


def q_validate_stats(spark, sf):
    s = validate(contacts(spark, sf), CONTACT_RULES).stats()
    return s.select(
        "total_records", "valid_records", "invalid_records",
        F.round("valid_percentage", 6).alias("valid_percentage"),
        F.round("invalid_percentage", 6).alias("invalid_percentage"),
    )


def q_failures_by_rule(spark, sf):
    f = validate(contacts(spark, sf), CONTACT_RULES).failures_by_rule()
    return f.select(F.col("rule_index").cast("bigint").alias("rule_index"), "field", "rule", "message", "failures")


def q_failures_observed(spark, sf):
    """E3 without an extra pass: counted by the KO write's own scan (an Observation)."""
    res = validate(contacts(spark, sf), CONTACT_RULES, observe=True)
    res.ko.write.format("noop").mode("overwrite").save()
    f = res.observed_failures(spark)
    return f.select(F.col("rule_index").cast("bigint").alias("rule_index"), "field", "rule", "message", "failures")


def q_validate_disabled_rule(spark, sf):
    rules = [{"field": "name", "validations": ["notNull", {"type": "minLength", "value": 2, "enabled": False}]},
             {"field": "zip", "validations": [{"type": "custom_expr", "expression": "length({column}) = 5"}]}]
    return _validate_ko_text(spark, sf, rules)


# ---------------------------------------------------------------------------
# Rules on typed columns of the driver tables
# ---------------------------------------------------------------------------

def q_typed(table: str, keys: list[str], rules: list[dict], spark, sf):
    return validate(read_table(spark, sf, table), rules).ok.select(*keys)


TYPED = {
    "rule_notEmpty_on_typed": ("orders", ["o_orderkey"], [{"field": "o_orderdate", "validations": ["notEmpty"]}]),
    "rule_integer_on_typed": ("lineitem", ["l_orderkey", "l_linenumber"],
                              [{"field": "l_linenumber", "validations": ["integer"]},
                               {"field": "l_returnflag", "validations": ["notEmpty"]}]),
    "rule_between_on_typed": ("lineitem", ["l_orderkey", "l_linenumber"],
                              [{"field": "l_discount", "validations": [{"type": "between", "min": 0.02, "max": 0.06}]}]),
    "rule_inList_on_typed": ("lineitem", ["l_orderkey", "l_linenumber"],
                             [{"field": "l_linenumber", "validations": [{"type": "inList", "values": ["1", "2", 3]}]}]),
    "rule_equals_on_typed": ("customer", ["c_custkey"],
                             [{"field": "c_nationkey", "validations": [{"type": "equals", "value": "7"}]}]),
    "rule_numeric_on_typed": ("customer", ["c_custkey"],
                              [{"field": "c_acctbal", "validations": ["numeric", "positive"]}]),
    "rule_notEmpty_on_array": ("embeddings", ["vec_id"], [{"field": "embedding", "validations": ["notEmpty"]}]),
    "rule_equals_on_int_flags": ("labels", ["doc_id"],
                                 [{"field": "quality", "validations": [{"type": "equals", "value": 1}]},
                                  {"field": "toxic", "validations": [{"type": "equals", "value": False}]}]),
    "rule_inList_on_roles": ("conversations", ["conv_id", "turn"],
                             [{"field": "role", "validations": [{"type": "inList", "values": ["user", "assistant"]}]}]),
    "rule_custom_sql_on_json": ("events", ["event_id"],
                                [{"field": "props", "validations": [
                                    {"type": "custom_sql",
                                     "expression": "CAST(get_json_object({column}, '$.k') AS INT) BETWEEN 10 AND 60"}]},
                                 {"field": "value", "validations": ["nonNegative"]}]),
    "validate_cross_field": ("lineitem", ["l_orderkey", "l_linenumber"],
                             [{"field": "l_discount", "validations": [
                                 {"type": "custom_sql", "expression": "{column} <= l_tax + 0.05"}]}]),
}

TEXT_RULES = [
    {"field": "text", "validations": [
        {"type": "minLength", "value": 40},
        {"type": "maxLength", "value": 20000, "message": "text too long"},
        {"type": "pattern", "regex": "^[A-Z]", "message": "must start with a capital letter"},
        {"type": "contains", "substring": " the "},
    ]},
    {"field": "lang", "validations": [{"type": "inList", "values": ["en", "fr", "de"]}]},
    {"field": "source", "validations": [{"type": "lengthBetween", "min_len": 4, "max_len": 4}]},
]


def q_text_quality(spark, sf):
    ko = validate(read_table(spark, sf, "documents"), TEXT_RULES).ko
    return ko.select("doc_id", "validation_errors_text")


PART_RULES = [
    {"field": "p_brand", "validations": [{"type": "pattern", "regex": "^Brand#[0-9]{2}$", "message": "brand code"}]},
    {"field": "p_size", "validations": [{"type": "between", "min": 5, "max": 45}, "integer"]},
    {"field": "p_retailprice", "validations": ["positive", {"type": "lessThan", "value": 990}]},
    {"field": "p_type", "message": "type not sold", "validations": [
        {"type": "inList", "values": ["ECONOMY", "SMALL", "STANDARD", "MEDIUM"]}]},
    {"field": "p_name", "validations": [{"type": "endsWith", "suffix": "bolt"}, {"type": "maxLength", "value": 12}]},
]


def q_part_catalog(spark, sf):
    ko = validate(read_table(spark, sf, "part"), PART_RULES, max_errors_per_row=3).ko
    return ko.select("p_partkey", "validation_errors_text")


SUPPLIER_RULES = [
    {"field": "s_acctbal", "validations": [{"type": "nonNegative", "message": "negative balance"}]},
    {"field": "s_name", "validations": [{"type": "pattern", "regex": "^Supplier#[0-9]{9}$"}]},
    {"field": "s_nationkey", "validations": [{"type": "between", "min": 0, "max": 19}]},
]
CONVERSATION_RULES = [
    {"field": "role", "validations": [{"type": "inList", "values": ["user", "assistant"]}]},
    {"field": "text", "validations": [{"type": "minLength", "value": 30}, {"type": "maxLength", "value": 1500}]},
    {"field": "turn", "validations": ["positive"]},
]


def q_suppliers(spark, sf):
    return validate(read_table(spark, sf, "supplier"), SUPPLIER_RULES).ko.select("s_suppkey", "validation_errors_text")


def q_conversations(spark, sf):
    ko = validate(read_table(spark, sf, "conversations"), CONVERSATION_RULES).ko
    return ko.select("conv_id", "turn", "validation_errors_text")


URL_RULES = [{"field": "url", "validations": ["url", {"type": "startsWith", "prefix": "https://"}]}]


def q_validate_urls(spark, sf):
    return validate(read_table(spark, sf, "pages"), URL_RULES).ok.select("page_id")


def _unique_flags(df: DataFrame, field: str, *keys: str) -> DataFrame:
    """Every row with its verdict: flagged once, not joined again for each half."""
    every = validate(df, [{"field": field, "validations": ["unique"]}]).annotated()
    return every.select(*keys, F.col("is_valid").alias("unique_ok"))


def q_unique_documents(spark, sf):
    return _unique_flags(read_table(spark, sf, "documents"), "text", "doc_id")


def q_unique_composite(spark, sf):
    """Uniqueness of a composite key: derive the key, then validate it."""
    conv = _steps(read_table(spark, sf, "conversations"),
                  ("derive_column", {"column": "conv_turn", "expression": "concat_ws(':', conv_id, turn)"}))
    return _unique_flags(conv, "conv_turn", "conv_id", "turn")


def q_unique_fields(spark, sf):
    """A key of two text columns, compared as a struct: no joining character can make two keys alike."""
    docs = read_table(spark, sf, "documents").select("doc_id", "source", F.substring("text", 1, 12).alias("start"))
    rules = [{"field": "source", "validations": [{"type": "unique", "fields": ["source", "start"]}]}]
    return validate(docs, rules).annotated().select("doc_id", F.col("is_valid").alias("unique_ok"))


def q_unique_lineitem(spark, sf):
    return _unique_flags(read_table(spark, sf, "lineitem"), "l_orderkey", "l_orderkey", "l_linenumber")


def q_unique_nulls(spark, sf):
    """A missing key is never unique; rows without one stay out of the way of the others."""
    return _unique_flags(contacts(spark, sf), "age_text", "id")


def q_unique_with_row_rules(spark, sf):
    """Keys are counted over the whole table; a row rule drops rows at the scan, before the join."""
    rules = [{"field": "l_orderkey", "validations": ["unique"]},
             {"field": "l_quantity", "validations": [{"type": "lessThan", "value": 25}]}]
    return validate(read_table(spark, sf, "lineitem"), rules).ok.select("l_orderkey", "l_linenumber")


def q_no_rules(spark, sf):
    ok, ko = validate(read_table(spark, sf, "customer"), [])
    return ok.select("c_custkey", F.lit("ok").alias("part")).unionByName(ko.select("c_custkey", F.lit("ko").alias("part")))


# ---------------------------------------------------------------------------
# Table steps (T1-T6) and the SQL expression surface
# ---------------------------------------------------------------------------

def q_scan_count(spark, sf):
    df = read_source(spark, {"name": "lineitem", "format": "PARQUET", "path": f"{sf}/lineitem.parquet"})
    return df.agg(F.count(F.lit(1)).alias("rows"))


def q_source_inventory(spark, sf):
    inv = source_inventory({t: read_table(spark, sf, t) for t in TABLES})
    return inv.groupBy("source").agg(
        F.count_distinct("file_path").alias("files"),
        F.sum("rows").alias("rows"),
        (F.min("file_size") > 0).alias("has_bytes"),
    )


def q_source_checks(spark, sf):
    doc = {"dataflows": [{"name": "all-tables", "sources": [
        {"name": t, "format": "PARQUET", "path": f"{sf}/{t}.parquet"} for t in TABLES]}]}
    return check_sources(spark, doc).select("name", "format", "exists", "files", "rows", (F.col("bytes") > 0).alias("has_bytes"))


def q_filter_rows(spark, sf):
    return _steps(read_table(spark, sf, "orders"),
                  ("filter_rows", {"condition": "o_totalprice >= 250000 AND o_orderstatus = 'F'"}),
                  ("select_columns", {"columns": ["o_orderkey", "o_totalprice"]}))


def q_filter_null_drops(spark, sf):
    return _steps(contacts(spark, sf), ("filter_rows", {"condition": "notes <> 'vip note'"}),
                  ("select_columns", {"columns": ["id"]}))


def q_derive_case(spark, sf):
    expr = "CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 10 THEN 'medium' ELSE 'small' END"
    return _steps(read_table(spark, sf, "lineitem"), ("derive_column", {"column": "qty_band", "expression": expr}),
                  ("select_columns", {"columns": ["l_orderkey", "l_linenumber", "qty_band"]}))


def q_derive_cast_date(spark, sf):
    return _steps(read_table(spark, sf, "orders"),
                  ("derive_column", {"column": "order_day", "expression": "CAST(o_orderdate AS DATE)"}),
                  ("derive_column", {"column": "order_day", "expression": "CAST(order_day AS STRING)"}),
                  ("select_columns", {"columns": ["o_orderkey", "order_day"]}))


def q_derive_literal(spark, sf):
    return _steps(read_table(spark, sf, "orders"), ("derive_column", {"column": "channel", "expression": "'batch'"}),
                  ("select_columns", {"columns": ["o_orderkey", "channel"]}))


def q_derive_explode(spark, sf):
    return _steps(read_table(spark, sf, "documents"),
                  ("derive_column", {"column": "x", "expression": "explode(array(lang, source))"}),
                  ("select_columns", {"columns": ["doc_id", "x"]}))


def q_derive_json(spark, sf):
    return _steps(read_table(spark, sf, "events"),
                  ("derive_column", {"column": "k", "expression": "get_json_object(props, '$.k')"}),
                  ("select_columns", {"columns": ["event_id", "k"]}))


def q_derive_replace(spark, sf):
    return _steps(read_table(spark, sf, "customer"), ("derive_column", {"column": "c_name", "expression": "upper(c_name)"}),
                  ("drop_columns", {"columns": ["c_acctbal", "c_mktsegment"]}))


def q_select_columns(spark, sf):
    return _steps(read_table(spark, sf, "customer"), ("select_columns", {"columns": ["c_custkey", "c_name", "c_acctbal"]}))


def q_rename_columns(spark, sf):
    return _steps(read_table(spark, sf, "part"), ("rename_columns", {"mappings": {"p_name": "name", "p_brand": "brand"}}))


def q_rename_chain(spark, sf):
    return _steps(read_table(spark, sf, "part"), ("rename_columns", {"mappings": {"p_name": "a", "a": "b", "zz": "yy"}}),
                  ("select_columns", {"columns": ["p_partkey", "b"]}))


def q_drop_columns(spark, sf):
    return _steps(read_table(spark, sf, "customer"), ("drop_columns", {"columns": ["c_name", "c_mktsegment", "nope"]}))


def q_add_fields(spark, sf):
    df = _steps(read_table(spark, sf, "orders"),
                ("add_fields", {"addFields": [{"name": "processed_at", "function": "current_timestamp"}]}))
    return df.select("o_orderkey", F.col("processed_at").isNotNull().alias("has_ts"))


# ---------------------------------------------------------------------------
# Dataflows, sinks and versions
# ---------------------------------------------------------------------------

def demo_document(sf: str, out: str | None = None) -> dict:
    """Every built-in step type over ``customer``; accepted rows to two paths, rejected rows to one."""
    check = [
        {"field": "name", "validations": ["notEmpty", {"type": "pattern", "regex": "^Customer#[0-9]{9}$"}]},
        {"field": "c_acctbal", "validations": [{"type": "nonNegative", "message": "balance must be >= 0"}]},
        {"field": "email", "validations": ["email"]},
        {"field": "c_nationkey", "validations": [{"type": "between", "min": 0, "max": 20}]},
        {"field": "seen_at", "validations": ["notNull"]},
    ]
    chain = [
        ("stamp", "add_fields", {"addFields": [{"name": "seen_at", "function": "current_timestamp"}]}),
        ("no_auto", "filter_rows", {"condition": "c_mktsegment <> 'AUTOMOBILE'"}),
        ("slim", "drop_columns", {"columns": ["c_mktsegment"]}),
        ("email", "derive_column", {"column": "email", "expression":
            "CASE WHEN c_custkey % 7 = 0 THEN concat('bad-', c_custkey) ELSE concat('u', c_custkey, '@example.com') END"}),
        ("bucket", "derive_column", {"column": "bucket", "expression":
            "CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'mid' ELSE 'negative' END"}),
        ("rename", "rename_columns", {"mappings": {"c_custkey": "id", "c_name": "name"}}),
        ("core", "select_columns", {"columns": ["id", "name", "email", "bucket", "c_acctbal", "c_nationkey", "seen_at"]}),
        ("check", "validate_fields", {"validations": check}),
    ]
    inputs = ["customers", *[name for name, _, _ in chain]]
    base = out or "/unused"
    return {"dataflows": [{
        "name": "customers-demo",
        "sources": [{"name": "customers", "format": "PARQUET", "path": f"{sf}/customer.parquet"}],
        "transformations": [{"name": name, "type": kind, "params": {"input": before, **params}}
                            for (name, kind, params), before in zip(chain, inputs)],
        "sinks": [
            {"name": "rejected", "input": "check_ko", "format": "json", "saveMode": "overwrite", "paths": [f"{base}/rejected"]},
            {"name": "accepted", "input": "check_ok", "format": "parquet", "saveMode": "overwrite",
             "paths": [f"{base}/accepted", f"{base}/accepted_copy"]},
        ],
    }]}


def fanout_document(sf: str) -> dict:
    """X2 fan-out and D5: two branches of one source, each validated by its own step."""
    return {"dataflows": [{"name": "orders-fanout",
        "sources": [{"name": "orders", "format": "PARQUET", "path": f"{sf}/orders.parquet"}],
        "transformations": [
            {"name": "finished", "type": "filter_rows", "params": {"input": "orders", "condition": "o_orderstatus = 'F'"}},
            {"name": "open", "type": "filter_rows", "params": {"input": "orders", "condition": "o_orderstatus = 'O'"}},
            {"name": "check_finished", "type": "validate_fields", "params": {"input": "finished", "validations": [
                {"field": "o_totalprice", "validations": [{"type": "greaterThan", "value": 50000}]}]}},
            {"name": "check_open", "type": "validate_fields", "params": {"input": "open", "validations": [
                {"field": "o_orderpriority", "validations": [{"type": "startsWith", "prefix": "1-"}]}]}},
        ],
        "sinks": [{"name": "unused", "input": "validation_ko", "format": "PARQUET", "saveMode": "OVERWRITE",
                   "paths": ["/unused"]}]}]}


def q_dataflow_fanout(spark, sf):
    flow = build_flow(spark, fanout_document(sf)["dataflows"][0], StepContext(run_id="q"))
    t = flow.tables
    # the fixed name points to the latest validate step; each step keeps its own names
    if t["validation_ko"] is not t["check_open_ko"]:
        raise RuntimeError("validation_ko should name the latest validate step's rejected rows")
    return t["check_finished_ko"].select("o_orderkey", F.lit("finished").alias("branch"), "validation_errors_text") \
        .unionByName(t["check_open_ko"].select("o_orderkey", F.lit("open").alias("branch"), "validation_errors_text"))


def q_dataflow_ko(spark, sf):
    flow = build_flow(spark, demo_document(sf)["dataflows"][0], StepContext(run_id="q"))
    return flow.tables["validation_ko"].select("id", "bucket", "validation_errors_text")


def q_dataflow_ok(spark, sf):
    flow = build_flow(spark, demo_document(sf)["dataflows"][0], StepContext(run_id="q"))
    return flow.tables["validation_ok"].select("id", "bucket", F.col("seen_at").isNotNull().alias("has_ts"))


def q_dataflow_written(spark, sf):
    out = scratch_path(spark, "dataflow")
    run(spark, demo_document(sf, out), run_id="q")
    ko = spark.read.schema("id long, bucket string, validation_errors map<string,array<string>>, "
                           "validation_errors_text string").json(f"{out}/rejected")
    return ko.select("id", "bucket", "validation_errors_text")


def q_dataflow_written_ok(spark, sf):
    out = scratch_path(spark, "dataflow")
    run(spark, demo_document(sf, out), run_id="q")
    return spark.read.parquet(f"{out}/accepted_copy").select("id", "bucket")


ORDERS_DDL = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def q_sink_roundtrip(fmt: str, spark, sf):
    orders = read_table(spark, sf, "orders")
    out = scratch_path(spark, f"sink-{fmt}")
    options = {"header": "true"} if fmt == "csv" else {}
    write_sink(orders, {"name": fmt, "format": fmt.upper(), "saveMode": "OVERWRITE", "paths": [out], "options": options})
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("json", "csv"):
        reader = reader.schema(ORDERS_DDL)
    return reader.load(out).select(*orders.columns)


def q_sink_roundtrip_text(spark, sf):
    """K4: a text sink holds one JSON document per row; read it back as JSON lines."""
    orders = read_table(spark, sf, "orders")
    out = scratch_path(spark, "sink-text")
    write_sink(orders, {"name": "t", "format": "text", "saveMode": "overwrite", "paths": [out]})
    return spark.read.schema(ORDERS_DDL).json(out).select(*orders.columns)


def q_sink_csv_error_map(spark, sf):
    """K4: CSV cannot hold a map, so the error map is written as JSON text and parsed back."""
    ko = validate(contacts(spark, sf), CONTACT_RULES).ko.select("id", "validation_errors")
    out = scratch_path(spark, "sink-csv-map")
    write_sink(ko, {"name": "c", "format": "csv", "saveMode": "overwrite", "paths": [out], "options": {"header": True}})
    back = spark.read.option("header", "true").schema("id long, validation_errors string").csv(out)
    errors = F.from_json("validation_errors", "map<string,array<string>>")
    entries = F.array_sort(F.map_entries(errors))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), "|")
    return back.select("id", text.alias("errors_map_text"))


def q_sink_partitioned(spark, sf):
    orders = read_table(spark, sf, "orders")
    out = scratch_path(spark, "sink-part")
    write_sink(orders, {"name": "p", "format": "parquet", "saveMode": "overwrite", "paths": [out],
                        "partitionBy": ["o_orderstatus"]})
    return spark.read.parquet(out).select(*orders.columns)


def _versions(spark, sf):
    cust = read_table(spark, sf, "customer")
    base = scratch_path(spark, "versions")
    spec = {"name": "v", "format": "PARQUET", "saveMode": "OVERWRITE", "paths": [base], "versioning": {"enabled": True}}
    write_sink(cust.filter("c_acctbal > 0"), spec, run_id="run-1")
    write_sink(cust, spec, run_id="run-2")
    return base


def q_versioned_latest(spark, sf):
    return read_latest(spark, _versions(spark, sf))


def q_versioned_first(spark, sf):
    return read_version(spark, _versions(spark, sf), "run-1")


def q_ko_json_sink(spark, sf):
    ko = validate(contacts(spark, sf), CONTACT_RULES).ko
    out = scratch_path(spark, "ko-json")
    write_sink(ko, {"name": "ko", "format": "json", "saveMode": "overwrite", "paths": [out]})
    back = spark.read.schema(ko.schema).json(out)
    entries = F.array_sort(F.map_entries("validation_errors"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), "|")
    return back.select("id", "name", "notes", text.alias("errors_map_text"))


STREAM_RULES = [
    {"field": "o_totalprice", "validations": [{"type": "greaterThan", "value": 100000}]},
    {"field": "o_orderstatus", "validations": [{"type": "inList", "values": ["F", "O"]}]},
]


def _stream_orders(spark, sf, base: str | None = None, checkpoint: str = "_checkpoint") -> str:
    """Stream the orders table through validation (availableNow) into versioned sinks."""
    from dqflow.streaming import start_validated_stream

    schema = read_table(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    base = base or scratch_path(spark, "stream")
    ok = {"name": "ok", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/ok"], "versioning": True}
    ko = {"name": "ko", "format": "json", "saveMode": "overwrite", "paths": [f"{base}/ko"], "versioning": True}
    query = start_validated_stream(stream, STREAM_RULES, ok, ko, checkpoint_location=f"{base}/{checkpoint}",
                                   trigger={"availableNow": True})
    if not query.awaitTermination(timeout=900):  # availableNow ends by itself; never wait unbounded
        query.stop()
        raise TimeoutError("streaming validation did not finish")
    return base


def q_stream_ok(spark, sf):
    return read_versions(spark, f"{_stream_orders(spark, sf)}/ok").select("o_orderkey", "o_orderstatus")


def q_stream_ko(spark, sf):
    return read_versions(spark, f"{_stream_orders(spark, sf)}/ko").select("o_orderkey", "validation_errors_text")


def q_stream_two(spark, sf):
    """Two streams, each with its own checkpoint, into one base: nothing is overwritten."""
    base = scratch_path(spark, "stream")
    for checkpoint in ("a", "b"):
        _stream_orders(spark, sf, base, checkpoint)
    rows = read_versions(spark, f"{base}/ok")
    return rows.select("o_orderkey", F.lit(list_versions(spark, f"{base}/ok").count()).cast("long").alias("versions"))


def _dated_files(spark, sf):
    """The orders in three files by date, and a last one with a row after all others, which closes their windows."""
    path = scratch_path(spark, "stream-in")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("at"))
    cuts = [F.lit(c).cast("timestamp") for c in ("1900-01-01", "1994-03-01", "1996-06-01", "2100-01-01")]
    # A micro-batch is a file: its small row groups are read, and its keys counted, by many tasks.
    for first, last in zip(cuts, cuts[1:]):
        orders.where((F.col("at") >= first) & (F.col("at") < last)).coalesce(1).write.mode("append").option("parquet.block.size", 4 << 20).parquet(path)
    end = orders.limit(1).withColumns({"at": F.lit("2200-01-01").cast("timestamp"), "o_custkey": F.lit(None).cast("long")})
    end.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _awaited(query):
    if not query.awaitTermination(timeout=900):  # availableNow ends by itself; never wait unbounded
        query.stop()
        raise TimeoutError("the stream did not finish")


def q_stream_unique(spark, sf):
    """Customers with one order in 30 days, over four micro-batches."""
    from dqflow.streaming import Horizon, start_validated_stream

    base = scratch_path(spark, "stream-unique")
    rules = [{"field": "o_custkey", "validations": ["unique"]}, {"field": "o_totalprice", "validations": [{"type": "greaterThan", "value": 20000}]}]
    ok, ko = ({"name": n, "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/{n}"], "versioning": True} for n in ("ok", "ko"))
    _awaited(start_validated_stream(_dated_files(spark, sf), rules, ok, ko, checkpoint_location=f"{base}/checkpoint",
                                    trigger={"availableNow": True}, horizon=Horizon("at", "30 days", "1 day")))
    accepted = read_versions(spark, f"{base}/ok").select("o_orderkey", F.lit("").alias("errors"))
    return accepted.unionByName(read_versions(spark, f"{base}/ko").select("o_orderkey", F.col("validation_errors_text").alias("errors")))


def q_stream_totals(spark, sf):
    """Failures per rule, held over all micro-batches."""
    from dqflow.streaming import start_failure_totals

    base = scratch_path(spark, "stream-totals")
    sink = {"name": "totals", "format": "parquet", "saveMode": "overwrite", "paths": [f"{base}/totals"], "versioning": {"enabled": True, "keepLast": 2}}
    _awaited(start_failure_totals(_dated_files(spark, sf).where("at < '2150-01-01'"), STREAM_RULES, sink, checkpoint_location=f"{base}/checkpoint",
                                  trigger={"availableNow": True}))
    return read_latest(spark, f"{base}/totals").select("rule", "failures")


# ---------------------------------------------------------------------------
# Sources, modes, reports
# ---------------------------------------------------------------------------

def q_source(fmt: str, options: dict, spark, sf):
    """Orders written in a format and read by ``read_source`` with options and a schema."""
    orders = read_table(spark, sf, "orders")
    out = scratch_path(spark, f"source-{fmt}")
    write_sink(orders, {"name": fmt, "format": fmt, "saveMode": "overwrite", "paths": [out], "options": options})
    spec = {"name": "orders", "format": fmt.upper(), "path": out, "options": options}
    if fmt != "orc":
        spec["schema"] = ORDERS_DDL
    return read_source(spark, spec).select(*orders.columns)


def q_source_inferred(spark, sf):
    """A CSV source whose types are inferred."""
    out = scratch_path(spark, "source-inferred")
    options = {"header": True, "sep": ";"}
    write_sink(read_table(spark, sf, "orders"), {"name": "o", "format": "csv", "saveMode": "overwrite", "paths": [out], "options": options})
    df = read_source(spark, {"name": "o", "format": "csv", "path": out, "options": {**options, "inferSchema": True}})
    return _steps(df, ("filter_rows", {"condition": "o_totalprice >= 250000"}),
                  ("select_columns", {"columns": ["o_orderkey", "o_orderpriority"]})).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("long"))


def q_run_report(spark, sf):
    """Row counts of sources, steps and sinks, observed by the sinks' own jobs."""
    out = scratch_path(spark, "report")
    doc = {"dataflows": [{
        "name": "report", "sources": [{"name": "orders", "format": "parquet", "path": f"{sf}/orders.parquet"}],
        "transformations": [
            {"name": "finished", "type": "filter_rows", "params": {"input": "orders", "condition": "o_orderstatus = 'F'"}},
            {"name": "cheap", "type": "validate_fields", "params": {"input": "finished", "validations": [
                {"field": "o_totalprice", "validations": [{"type": "lessThan", "value": 50000}]}]}}],
        "sinks": [{"name": "cheap", "input": "cheap_ok", "format": "parquet", "saveMode": "overwrite", "paths": [f"{out}/cheap"]},
                  {"name": "dear", "input": "cheap_ko", "format": "parquet", "saveMode": "overwrite", "paths": [f"{out}/dear"]}]}]}
    report = run(spark, doc, run_id="report", observe_tables=True).report(spark)
    return report.where("kind IN ('source', 'step', 'sink')").select("kind", "name", "rows")


def q_sink_modes(spark, sf):
    """K5: append adds, ignore leaves alone, error refuses."""
    orders = read_table(spark, sf, "orders")
    spec = {"name": "m", "format": "parquet", "paths": [scratch_path(spark, "modes")]}
    for mode in ("errorIfExists", "APPEND", "ignore"):
        write_sink(orders, {**spec, "saveMode": mode})
    try:
        write_sink(orders, {**spec, "saveMode": "error"})
    except SinkError:
        pass
    else:
        raise RuntimeError("writing to an existing path should have failed")
    return spark.read.parquet(*spec["paths"]).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


def q_user_transform(spark, sf):
    """A step type of the user's own."""
    register_transform("net_price", lambda df, params, ctx: df.withColumn(params["column"], F.expr("l_extendedprice * (1 - l_discount)")))
    return _steps(read_table(spark, sf, "lineitem"), ("net_price", {"column": "net"}),
                  ("select_columns", {"columns": ["l_orderkey", "l_linenumber", "net"]}))


def q_all_dataflows(spark, sf):
    """E5: every dataflow of a document runs."""
    out = scratch_path(spark, "flows")
    flows = [{"name": f"f{k}", "sources": [{"name": "t", "format": "parquet", "path": f"{sf}/{table}.parquet"}],
              "transformations": [{"name": "debt", "type": "filter_rows", "params": {"input": "t", "condition": f"{balance} < 0"}}],
              "sinks": [{"name": "k", "input": "debt", "format": "parquet", "saveMode": "overwrite", "paths": [f"{out}/f{k}"]}]}
             for k, (table, balance) in enumerate((("customer", "c_acctbal"), ("supplier", "s_acctbal")))]
    run(spark, {"dataflows": flows}, run_id="q")
    read = lambda k, key: spark.read.parquet(f"{out}/f{k}").select(F.lit(f"f{k}").alias("flow"), F.col(key).alias("key"))
    return read(0, "c_custkey").unionByName(read(1, "s_suppkey"))


def q_shared_sinks(spark, sf):
    """A partitioned sink with '' keys comes first; the second sink still gets them."""
    out = scratch_path(spark, "shared")
    part = "CASE WHEN id % 5 = 0 THEN '' WHEN id % 7 = 0 THEN NULL ELSE segment END"
    rows = contacts(spark, sf).select("id", F.expr(part).alias("part"))
    source = scratch_path(spark, "shared-in")
    write_sink(rows, {"name": "in", "format": "parquet", "saveMode": "overwrite", "paths": [source]})
    doc = {"dataflows": [{
        "name": "shared", "sources": [{"name": "rows", "format": "parquet", "path": source}],
        "sinks": [{"name": "parts", "input": "rows", "format": "parquet", "saveMode": "overwrite", "paths": [f"{out}/parts"], "partitionBy": ["part"]},
                  {"name": "plain", "input": "rows", "format": "parquet", "saveMode": "overwrite", "paths": [f"{out}/plain"]}]}]}
    run(spark, doc, run_id="q")
    return spark.read.parquet(f"{out}/plain")


def q_versioned(fmt: str, options: dict, expressions: tuple[str, ...], spark, sf):
    """K9: the manifest tells how a CSV or JSON version is read."""
    base = scratch_path(spark, f"versioned-{fmt}")
    rows = read_table(spark, sf, "customer").selectExpr(*expressions)
    spec = {"name": "v", "format": fmt, "saveMode": "overwrite", "paths": [base], "versioning": True, "options": options}
    write_sink(rows.where("c_custkey % 2 = 0"), spec, run_id="first")
    write_sink(rows, spec, run_id="second")
    return read_latest(spark, base)


def q_versioned_compacted(spark, sf):
    """K8, K9: a manifest that is compacted every third commit and keeps the four newest versions."""
    base = scratch_path(spark, "versioned-compacted")
    rows = read_table(spark, sf, "customer").select("c_custkey")
    spec = {"name": "v", "format": "parquet", "saveMode": "overwrite", "paths": [base],
            "versioning": {"enabled": True, "compactEvery": 3, "keepLast": 4}}
    for k in range(7):
        write_sink(rows.where(F.col("c_custkey") % 7 == k), spec, run_id=f"run-{k}")
    return read_versions(spark, base)


def q_source_checks_empty(spark, sf):
    """A source without rows exists; a path without files does not."""
    out = scratch_path(spark, "checks")
    customer = read_table(spark, sf, "customer")
    for name, rows in (("all", customer), ("none", customer.where("c_custkey < 0"))):
        rows.coalesce(1).write.parquet(f"{out}/{name}")
    doc = {"dataflows": [{"name": "c", "sources": [
        {"name": name, "format": "parquet", "path": f"{out}/{name}"} for name in ("all", "none", "missing")]}]}
    return check_sources(spark, doc).select("name", "exists", "files", "rows")


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

def _llm():
    """The training-data operators' queries, where that subpackage can be imported."""
    try:
        return importlib.import_module("dqflow.llm.queries")
    except ImportError:
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "scan_parquet_count": q_scan_count,
        "source_inventory": q_source_inventory,
        "source_checks": q_source_checks,
        "filter_rows": q_filter_rows,
        "filter_rows_null_drops": q_filter_null_drops,
        "derive_case": q_derive_case,
        "derive_cast_date": q_derive_cast_date,
        "derive_literal": q_derive_literal,
        "derive_explode": q_derive_explode,
        "derive_json": q_derive_json,
        "derive_replace_existing": q_derive_replace,
        "select_columns": q_select_columns,
        "rename_columns": q_rename_columns,
        "rename_chain": q_rename_chain,
        "drop_columns": q_drop_columns,
        "add_fields": q_add_fields,
    }
    for rule in SINGLE_RULES:
        q[f"rule_{rule}"] = partial(q_rule, rule)
    for name, (table, keys, rules) in TYPED.items():
        q[name] = partial(q_typed, table, keys, rules)
    q.update({
        "validate_ok": q_validate_ok,
        "validate_ko_text": lambda spark, sf: _validate_ko_text(spark, sf),
        "validate_ko_map": q_validate_ko_map,
        "validate_ko_array": q_validate_ko_array,
        "validate_truncated_text": q_validate_truncated,
        "validate_message_precedence": q_validate_precedence,
        "validate_same_field_twice": q_validate_same_field,
        "validate_disabled_rule": q_validate_disabled_rule,
        "validate_stats": q_validate_stats,
        "validate_annotated": q_validate_annotated,
        "validate_text_quality": q_text_quality,
        "validate_urls": q_validate_urls,
        "validate_part_catalog": q_part_catalog,
        "validate_suppliers": q_suppliers,
        "validate_conversations": q_conversations,
        "failures_by_rule": q_failures_by_rule,
        "failures_by_rule_observed": q_failures_observed,
        "unique_rule_documents": q_unique_documents,
        "unique_rule_lineitem": q_unique_lineitem,
        "unique_rule_composite": q_unique_composite,
        "dataflow_full_ko": q_dataflow_ko,
        "dataflow_full_ok": q_dataflow_ok,
        "dataflow_fanout": q_dataflow_fanout,
        "dataflow_written_ko": q_dataflow_written,
        "dataflow_written_ok": q_dataflow_written_ok,
        "sink_roundtrip_json": partial(q_sink_roundtrip, "json"),
        "sink_roundtrip_csv": partial(q_sink_roundtrip, "csv"),
        "sink_roundtrip_parquet": partial(q_sink_roundtrip, "parquet"),
        "sink_roundtrip_orc": partial(q_sink_roundtrip, "orc"),
        "sink_partitioned": q_sink_partitioned,
        "sink_roundtrip_text": q_sink_roundtrip_text,
        "sink_csv_error_map": q_sink_csv_error_map,
        "sink_ko_json_map": q_ko_json_sink,
        "versioned_latest": q_versioned_latest,
        "versioned_first": q_versioned_first,
        "stream_validate_ok": q_stream_ok,
        "stream_validate_ko": q_stream_ko,
        "source_json": partial(q_source, "json", {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}),
        "source_csv": partial(q_source, "csv", {"header": True, "sep": "|"}),
        "source_orc": partial(q_source, "orc", {"compression": "zlib"}),
        "source_csv_inferred": q_source_inferred,
        "run_report": q_run_report,
        "sink_append_ignore_error": q_sink_modes,
        "validate_no_rules": q_no_rules,
        "user_transform": q_user_transform,
        "all_dataflows": q_all_dataflows,
        "dataflow_shared_sinks": q_shared_sinks,
        "unique_rule_nulls": q_unique_nulls,
        "unique_rule_with_row_rules": q_unique_with_row_rules,
        "stream_two_queries": q_stream_two,
        "stream_unique": q_stream_unique,
        "stream_totals": q_stream_totals,
        "unique_rule_fields": q_unique_fields,
        "versioned_csv_latest": partial(q_versioned, "csv", {"header": True, "sep": ";"},
                                        ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")),
        "versioned_compacted": q_versioned_compacted,
        "versioned_json_latest": partial(q_versioned, "json", {},
                                         ("CAST(c_custkey AS INT) AS c_custkey", "c_name", "CAST(NULL AS DOUBLE) AS bonus")),
        "source_checks_empty": q_source_checks_empty,
    })
    if llm := _llm():
        q.update(llm.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from duckdb_oracle import oracle_queries

    sql = oracle_queries()
    if llm := _llm():
        sql.update(llm.oracle_sql())
    return sql
