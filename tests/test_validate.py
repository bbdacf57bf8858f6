"""validate_fields (T7, D-1..D-14, E1, E3, E4)."""

import collections
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqflow import apply_validations, validate
from dqflow.operators.quality import flag_duplicates

SCHEMA = "id int, name string, age long, zip string, status string"
ROWS = [
    (1, "Alice", 30, "94105", "ACTIVE"),
    (2, "B", 25, "9410", "ACTIVE"),
    (3, None, -5, "SW1A1AA", "GOLD"),
    (4, "", 151, None, None),
]
RULES = [
    {"field": "name", "validations": ["notNull", "notEmpty", {"type": "minLength", "value": 2, "message": "short"}]},
    {"field": "age", "message": "bad age", "validations": ["nonNegative", {"type": "between", "min": 0, "max": 150}]},
    {"field": "zip", "validations": [{"type": "pattern", "regex": "^[0-9]{5}$"}]},
    {"field": "status", "validations": [{"type": "inList", "values": ["ACTIVE", "PENDING"]}]},
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_split_and_report(people):
    ok, ko = validate(people, RULES)
    assert [r.id for r in ok.collect()] == [1]
    assert ok.columns == people.columns
    ko_rows = _by_id(ko)
    assert set(ko_rows) == {2, 3, 4}
    assert ko.columns == people.columns + ["validation_errors", "validation_errors_text"]
    assert dict(ko_rows[2]["validation_errors"]) == {"name": ["short"], "zip": ["zip:pattern"]}
    assert ko_rows[2]["validation_errors_text"] == "short; zip:pattern"
    assert ko_rows[3]["validation_errors_text"] == (
        "name:notNull; name:notEmpty; short; bad age; bad age; zip:pattern; status:inList")
    assert set(ko_rows[3]["validation_errors"]) == {"name", "age", "zip", "status"}
    assert ko_rows[4]["validation_errors"]["age"] == ["bad age"]
    assert ko_rows[4]["validation_errors_text"] == "name:notEmpty; short; bad age; zip:pattern; status:inList"
    types = dict(ko.dtypes)
    assert types["validation_errors"] == "map<string,array<string>>"


def test_truncation_and_array(people):
    ko = validate(people, RULES, max_errors_per_row=2, max_errors_per_field=1, keep_array=True).ko
    r = _by_id(ko)[3]
    assert r["validation_errors_text"] == "name:notNull; name:notEmpty; ... (+5 more)"
    assert r["validation_errors"]["name"] == ["name:notNull"]
    assert len(r["validation_errors_array"]) == 7  # untruncated (D-10)
    ko_all = validate(people, RULES, max_errors_per_row=0, max_errors_per_field=0).ko
    assert _by_id(ko_all)[3]["validation_errors_text"].count(";") == 6


def test_empty_and_disabled_rules(people):
    ok, ko = validate(people, [])
    assert ok.count() == 4 and ko.count() == 0
    assert ko.columns[-2:] == ["validation_errors", "validation_errors_text"]
    ok, ko = apply_validations(people, [{"field": "name", "validations": [{"type": "notNull", "enabled": False}]}])
    assert ok.count() == 4 and ko.count() == 0


def test_same_field_blocks_merge(people):
    rules = [{"field": "name", "validations": ["notNull"]},
             {"field": "zip", "validations": ["notNull"]},
             {"field": "name", "message": "m2", "validations": [{"type": "minLength", "value": 2}]}]
    r = _by_id(validate(people, rules).ko)
    assert r[3]["validation_errors_text"] == "name:notNull; m2"
    assert dict(r[3]["validation_errors"]) == {"name": ["name:notNull", "m2"]}
    assert r[4]["validation_errors_text"] == "m2; zip:notNull"
    assert r[2]["validation_errors_text"] == "m2"


def test_similar_field_names_keep_own_messages(spark):
    df = spark.createDataFrame([(1, None, "x")], "id int, `a-b` string, a_b string")
    rules = [{"field": "a-b", "validations": ["notNull"]}, {"field": "a_b", "validations": [{"type": "equals", "value": "y"}]}]
    r = validate(df, rules).ko.first()
    assert dict(r["validation_errors"]) == {"a-b": ["a-b:notNull"], "a_b": ["a_b:equals"]}


def test_nested_and_dotted_fields(spark):
    df = spark.createDataFrame([(1, (None,), "x"), (2, ("v",), None)], "id int, s struct<x:string>, `a.b` string")
    ko = _by_id(validate(df, [{"field": "s.x", "validations": ["notNull"]},
                              {"field": "a.b", "validations": ["notNull"]}]).ko)
    assert ko[1]["validation_errors_text"] == "s.x:notNull"
    assert ko[2]["validation_errors_text"] == "a.b:notNull"


def test_stats_and_failures(people):
    res = validate(people, RULES)
    s = res.stats().first()
    assert (s.total_records, s.valid_records, s.invalid_records) == (4, 1, 3)
    assert s.valid_percentage == pytest.approx(25.0) and s.invalid_percentage == pytest.approx(75.0)
    f = {(r.field, r.rule): r.failures for r in res.failures_by_rule().collect()}
    assert f[("name", "notNull")] == 1 and f[("name", "notEmpty")] == 2 and f[("name", "minLength")] == 3
    assert f[("age", "between")] == 2 and f[("zip", "pattern")] == 3 and f[("status", "inList")] == 2


def test_stats_empty_input(spark):
    df = spark.createDataFrame([], "id int, name string")
    s = validate(df, [{"field": "name", "validations": ["notNull"]}]).stats().first()
    assert (s.total_records, s.valid_percentage, s.invalid_percentage) == (0, 0.0, 0.0)


@pytest.mark.parametrize("materialize", ["persist", "checkpoint"])
def test_materialized_split_matches(people, materialize):
    base = validate(people, RULES)
    mat = validate(people, RULES, materialize=materialize)
    assert sorted(base.ok.collect()) == sorted(mat.ok.collect())
    key = lambda r: r.id
    a = [(r.id, r.validation_errors_text, dict(r.validation_errors)) for r in sorted(base.ko.collect(), key=key)]
    b = [(r.id, r.validation_errors_text, dict(r.validation_errors)) for r in sorted(mat.ko.collect(), key=key)]
    assert a == b
    assert mat.stats().first().asDict() == base.stats().first().asDict()


# --- E1: unique -------------------------------------------------------------

@pytest.mark.parametrize("per_salt", [1_000_000, 40, 7, 1])
def test_unique_matches_brute_force(spark, per_salt):
    rnd = random.Random(7)
    keys = [0] * 300 + [rnd.randint(1, 200) for _ in range(500)] + [None] * 20  # key 0 holds ~36%
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int").repartition(5)
    res = validate(df, [{"field": "k", "validations": ["unique"]}], rows_per_salt=per_salt)
    counts = collections.Counter(k for k in keys if k is not None)
    expected_ok = {i for i, k in enumerate(keys) if k is not None and counts[k] == 1}
    assert {r.id for r in res.ok.collect()} == expected_ok
    assert res.ko.count() == len(keys) - len(expected_ok)
    assert res.ok.columns == ["id", "k"]


def test_flag_duplicates_keeps_rows(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)] + [(99, 7)], "id int, k int")
    out = flag_duplicates(df, F.col("k"), "dup", rows_per_salt=3)
    rows = {r.id: r.dup for r in out.collect()}
    assert len(rows) == 31 and rows[99] is False and all(rows[i] for i in range(30))


# --- invariants over random rows ---------------------------------------------

TEXT = st.one_of(st.none(), st.sampled_from(["", " ", "a", "ab", "12", "-3", "1.5", "x@y", "ACTIVE", "n/a"]))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT), min_size=0, max_size=25))
def test_invariants(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                               T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.StringType()),
                                             T.StructField("b", T.StringType())]))
    rules = [{"field": "a", "validations": ["notEmpty", {"type": "maxLength", "value": 2}]},
             {"field": "b", "validations": ["numeric", "positive", {"type": "inList", "values": ["12", "1.5", "ab"]}]}]
    res = validate(df, rules, keep_array=True)
    ok, ko = res.ok.collect(), res.ko.collect()
    assert len(ok) + len(ko) == len(rows)
    assert {r.id for r in ok}.isdisjoint({r.id for r in ko})

    def fails(a, b):
        out = []
        if a is None or a == "":
            out.append("a:notEmpty")
        if a is None or len(a) > 2:
            out.append("a:maxLength")
        try:
            num = float(b) if b is not None else None
        except ValueError:
            num = None
        if num is None:
            out += ["b:numeric", "b:positive"]
        elif not num > 0:
            out.append("b:positive")
        if b not in ("12", "1.5", "ab"):
            out.append("b:inList")
        return out

    for r in ok:
        assert fails(r.a, r.b) == []
    for r in ko:
        exp = fails(r.a, r.b)
        assert exp and list(r.validation_errors_array) == exp
        assert r.validation_errors_text == "; ".join(exp)
        flat = [m for v in r.validation_errors.values() for m in v]
        assert flat == exp


def test_hundreds_of_rules(spark):
    """A wide rule set neither overflows the JVM stack nor loses labels (balanced AND tree)."""
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "id int, x double")
    rules = [{"field": "x", "validations": [{"type": "lessThan", "value": 10 + (i % 10), "message": f"r{i}"}]}
             for i in range(400)]
    res = validate(df, rules, max_errors_per_row=0, max_errors_per_field=0)
    assert res.ok.count() == 10
    row = {r.id: r for r in res.ko.collect()}[19]
    assert len(row.validation_errors["x"]) == 400
    assert res.failures_by_rule().count() == 400


def test_hot_key_is_spread_over_join_tasks(spark):
    """A key holding a third of the rows must not land in a single join task."""
    n_hot, n_rest = 3000, 6000
    rows = [(i, 0) for i in range(n_hot)] + [(n_hot + i, 1 + i // 2) for i in range(n_rest)]
    df = spark.createDataFrame(rows, "id int, k int").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_duplicates(df, F.col("k"), "dup", rows_per_salt=200)
        per_task = flagged.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_if((F.col("k") == 0) & F.col("dup")).alias("hot_rows")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot_rows = [r.hot_rows for r in per_task]
    assert sum(hot_rows) == n_hot
    assert max(hot_rows) <= n_hot // 4  # spread over many tasks, not one
    assert flagged.filter("dup").count() == n_hot + n_rest


def test_two_hundred_hot_keys_are_all_spread(spark):
    """Every key above the share is split, however many there are."""
    n_keys, n_each = 200, 300
    rows = spark.range(n_keys * n_each + 5000, numPartitions=8).selectExpr("id", f"CASE WHEN id < {n_keys * n_each} THEN id % {n_keys} ELSE id END AS k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        flagged = flag_duplicates(rows, F.col("k"), "dup", rows_per_salt=30)
        per_task = flagged.where("dup").groupBy("k", F.spark_partition_id().alias("p")).count()
        most = per_task.groupBy("k").agg(F.max("count").alias("most"), F.sum("count").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(most) == n_keys and all(r.n == n_each for r in most)
    assert max(r.most for r in most) <= 5 * 30  # a few salts of a key may meet in a task, never all ten


def test_unique_float_keys_signed_zero_and_nan(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, float("nan")), (4, float("nan")), (5, 1.5)], "id int, k double")
    for per_salt in (1, 100):
        res = validate(df, [{"field": "k", "validations": ["unique"]}], rows_per_salt=per_salt)
        assert {r.id for r in res.ok.collect()} == {5}


@pytest.mark.parametrize("materialize", ["none", "persist", "checkpoint"])
def test_observed_metrics_match_aggregates(people, spark, materialize):
    res = validate(people, RULES, observe=True, materialize=materialize)
    res.ko.write.format("noop").mode("overwrite").save()
    assert res.observed_stats(spark).first().asDict() == res.stats().first().asDict()
    key = lambda r: r.rule_index
    assert sorted(res.observed_failures(spark).collect(), key=key) == sorted(res.failures_by_rule().collect(), key=key)


def test_annotated_table_one_pass(people, spark, tmp_path):
    res = validate(people, RULES)
    every = res.annotated()
    assert every.columns == people.columns + ["is_valid", "validation_errors", "validation_errors_text"]
    rows = {r.id: r for r in every.collect()}
    assert rows[1].is_valid and rows[1].validation_errors is None and rows[1].validation_errors_text is None
    ko = {r.id: r.validation_errors_text for r in res.ko.collect()}
    assert {i: rows[i].validation_errors_text for i in ko} == ko
    every.write.partitionBy("is_valid").parquet(str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split" / "is_valid=false")).count() == 3


def test_awkward_field_names(spark):
    df = spark.createDataFrame([(1, None, "x", "a"), (2, "v", None, "b")], "id int, `my col` string, `we``ird` string, Name string")
    rules = [{"field": "my col", "validations": ["notNull", {"type": "custom_sql", "expression": "{column} <> 'z'"}]},
             {"field": "we`ird", "validations": ["notNull"]},
             {"field": "NAME", "validations": [{"type": "equals", "value": "a"}]}]
    res = validate(df, rules)
    assert res.ok.count() == 0
    ko = {r.id: (dict(r.validation_errors), r.validation_errors_text) for r in res.ko.collect()}
    assert ko[1] == ({"my col": ["my col:notNull", "my col:custom_sql"]}, "my col:notNull; my col:custom_sql")
    assert ko[2] == ({"we`ird": ["we`ird:notNull"], "NAME": ["NAME:equals"]}, "we`ird:notNull; NAME:equals")
    assert res.ok.columns == df.columns


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 6), st.sampled_from(["a", "b", "zz"]).map(lambda s: 100 + len(s))),
             min_size=0, max_size=60),
    st.integers(1, 8),
)
def test_flag_duplicates_random(spark, keys, per_salt):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int")
    out = flag_duplicates(df, F.col("k"), "dup", rows_per_salt=per_salt)
    got = {r.id: r.dup for r in out.collect()}
    counts = collections.Counter(k for k in keys if k is not None)
    assert got == {i: (k is not None and counts[k] > 1) for i, k in enumerate(keys)}


VALUES = st.one_of(st.none(), st.sampled_from(["", "a", "ab", "abc", "cab", "b1", "12", "-4", "7.5", "150", "x y"]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(VALUES, VALUES), min_size=1, max_size=20), st.integers(0, 4), st.integers(0, 3))
def test_report_matches_model(spark, rows, max_row, max_field):
    import re

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a string, b string")
    rules = [
        {"field": "a", "message": "bad a", "validations": [
            {"type": "minLength", "value": 2}, {"type": "pattern", "regex": "^[a-c]+$", "message": "a letters"},
            {"type": "startsWith", "prefix": "a"}]},
        {"field": "b", "validations": [{"type": "between", "min": 0, "max": 100}, {"type": "contains", "substring": "1"},
                                       {"type": "equals", "value": "12"}]},
    ]
    res = validate(df, rules, max_errors_per_row=max_row, max_errors_per_field=max_field)

    def num(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None

    def model(a, b):
        fa, fb = [], []
        if a is None or len(a) < 2:
            fa.append("bad a")
        if a is None or not re.search("^[a-c]+$", a):
            fa.append("a letters")
        if a is None or not a.startswith("a"):
            fa.append("bad a")
        n = num(b)
        if n is None or not (0 <= n <= 100):
            fb.append("b:between")
        if b is None or "1" not in b:
            fb.append("b:contains")
        if b != "12":
            fb.append("b:equals")
        return fa, fb

    expected_ko = {}
    for i, (a, b) in enumerate(rows):
        fa, fb = model(a, b)
        flat = fa + fb
        if not flat:
            continue
        shown = flat[:max_row] if max_row > 0 else flat
        text = "; ".join(shown)
        if max_row > 0 and len(flat) > max_row:
            text += f"; ... (+{len(flat) - max_row} more)"
        cut = (lambda xs: xs[:max_field] if max_field > 0 else xs)
        emap = {k: cut(v) for k, v in (("a", fa), ("b", fb)) if v}
        expected_ko[i] = (text, emap)
    got = {r.id: (r.validation_errors_text, {k: list(v) for k, v in r.validation_errors.items()})
           for r in res.ko.collect()}
    assert got == expected_ko
    assert {r.id for r in res.ok.collect()} == set(range(len(rows))) - set(expected_ko)


def _spread(spark, rows, schema="id int, k int", per_salt=200):
    """Rows of each key in each task of the join that marks duplicates."""
    df = spark.createDataFrame(rows, schema).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        flagged = flag_duplicates(df, F.col("k"), "dup", rows_per_salt=per_salt)
        return flagged.groupBy(F.spark_partition_id().alias("p"), "k").agg(F.count(F.lit(1)).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_every_hot_key_is_spread(spark):
    """Two hundred keys over the limit: each is split, not only the first of them."""
    tasks = _spread(spark, [(i, i % 200) for i in range(200 * 400)], per_salt=50)
    most = collections.Counter()
    for r in tasks:
        most[r.k] = max(most[r.k], r.n)
    assert max(most.values()) <= 250  # of 400 rows in eight salts


def test_null_keys_are_spread(spark):
    tasks = _spread(spark, [(i, None if i % 2 else i) for i in range(20000)])
    nulls = [r.n for r in tasks if r.k is None]
    assert sum(nulls) == 10000 and max(nulls) <= 2000


def test_unique_counts_over_all_rows_with_row_rules(spark):
    df = spark.createDataFrame([(1, 7, "a"), (2, 7, ""), (3, 8, "b"), (4, 9, ""), (5, None, "c")], "id int, k int, s string")
    res = validate(df, [{"field": "k", "validations": ["unique"]}, {"field": "s", "validations": ["notEmpty"]}])
    assert [r.id for r in res.ok.collect()] == [3]  # id 1 repeats a key whose other row fails
    assert sorted(r.id for r in res.ko.collect()) == [1, 2, 4, 5]


def test_labels_are_not_cut_by_default(spark):
    df = spark.createDataFrame([(None,)], "a string")
    rules = [{"field": "a", "validations": [{"type": "minLength", "value": k, "message": f"m{k}"} for k in range(1, 121)]}]
    row = validate(df, rules).ko.first()
    assert len(row.validation_errors["a"]) == 120 and row.validation_errors_text.count(";") == 119


@pytest.mark.parametrize("materialize", ["none", "persist"])
def test_no_row_is_lost_without_determinism(spark, materialize):
    df = spark.range(1000)
    for source, rules in (
            (df, [{"field": "id", "validations": [{"type": "custom_sql", "expression": "rand() > 0.5"}]}]),
            (df.withColumn("u", F.expr("uuid()")), [{"field": "u", "validations": [{"type": "custom_sql", "expression": "{column} < '8'"}]}])):
        res = validate(source, rules, materialize=materialize)
        ok, ko = {r.id for r in res.ok.collect()}, {r.id for r in res.ko.collect()}
        assert not ok & ko and len(ok) + len(ko) == 1000
        assert res.ko.where("validation_errors_text = 'Unknown validation error'").count() == 0


def test_observed_failures_when_no_row_can_fail(spark):
    df = spark.range(5)  # a column that is never null
    res = validate(df, [{"field": "id", "validations": ["notNull"]}], observe=True)
    res.ko.write.format("noop").mode("overwrite").save()
    assert [(r.rule, r.failures) for r in res.observed_failures(spark).collect()] == [("notNull", 0)]
    assert res.observed_stats(spark).first().total_records == 5
