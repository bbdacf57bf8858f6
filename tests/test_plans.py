"""Plan checks: pushdown, codegen, no Python UDFs, bounded broadcast, jobs per run."""

import pytest

from dqflow import validate
from dqflow.plans.dataflow import run
from dqflow.plans.workloads import contacts
from dqflow.sources.reader import read_table

from conftest import SF_SMALL

LINE_RULES = [
    {"field": "l_quantity", "validations": ["positive", {"type": "between", "min": 1, "max": 50}]},
    {"field": "l_returnflag", "validations": [{"type": "inList", "values": ["A", "N", "R"]}]},
    {"field": "l_linestatus", "validations": [{"type": "equals", "value": "O"}]},
    {"field": "l_shipdate", "validations": ["notNull"]},
]


def plan(df, mode="formatted"):
    """The text of ``df.explain(mode)``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_ok_branch_pushes_rules_to_scan(spark):
    ok = validate(read_table(spark, SF_SMALL, "lineitem"), LINE_RULES).ok
    text = plan(ok)
    pushed = [l for l in text.splitlines() if l.startswith("PushedFilters")][0]
    for f in ("GreaterThan(l_quantity", "In(l_returnflag", "EqualTo(l_linestatus,O)", "IsNotNull(l_shipdate)"):
        assert f in pushed


def test_no_python_in_plans(spark):
    res = validate(read_table(spark, SF_SMALL, "lineitem"), LINE_RULES)
    for df in (res.ok, res.ko, res.failures_by_rule(), res.stats()):
        text = plan(df, "extended")
        assert "Python" not in text and "ArrowEval" not in text


def _largest_method(df):
    """Bytecode of the largest method among a plan's whole-stage-codegen stages (0: there are none)."""
    import re

    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))), default=0)


@pytest.mark.parametrize("n", [25, 100, 200])
def test_methods_stay_below_what_the_jvm_compiles(spark, n):
    """Above 8,000 bytes of bytecode the JVM interprets a method."""
    kinds = [{"type": "pattern", "regex": "^[a-z]{%d}$"}, {"type": "minLength", "value": 2}, {"type": "contains", "substring": "x"}, "integer", "notEmpty", "notNull"]
    rules = []
    for k in range(n):
        kind = kinds[k % len(kinds)]
        if isinstance(kind, dict):
            kind = {**kind, "message": f"rule {k}"}
            if "regex" in kind:
                kind["regex"] = kind["regex"] % k
        rules.append({"field": ("name", "email", "phone", "zip")[k % 4], "validations": [kind]})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        res = validate(contacts(spark, SF_SMALL), rules)
        sizes = {part: _largest_method(df) for part, df in (("ok", res.ok), ("ko", res.ko), ("all", res.annotated()))}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes.values()) < 8000, sizes


def test_row_rules_reach_the_scan_next_to_unique(spark):
    rules = [{"field": "l_orderkey", "validations": ["unique"]}, {"field": "l_quantity", "validations": [{"type": "lessThan", "value": 10}]}]
    text = plan(validate(read_table(spark, SF_SMALL, "lineitem"), rules).ok)
    assert any("LessThan(l_quantity,10.0)" in line for line in text.splitlines() if line.startswith("PushedFilters"))


def test_unique_broadcasts_only_hashes_of_hot_keys(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(validate(li, [{"field": "l_orderkey", "validations": ["unique"]}]).ko, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_count" in text and "SortMergeJoin" in text and "TakeOrdered" not in text
    lines = text.splitlines()
    broadcasts = [i for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert broadcasts and all("__dq_hash" in "\n".join(lines[i:i + 3]) for i in broadcasts)


def test_jobs_equal_sink_paths(spark, tmp_path):
    out = str(tmp_path)
    doc = {"dataflows": [{"name": "j", "sources": [
        {"name": "li", "format": "PARQUET", "path": f"{SF_SMALL}/lineitem.parquet"}],
        "transformations": [{"name": "v", "type": "validate_fields", "params": {"input": "li", "validations": LINE_RULES}}],
        "sinks": [{"name": "ok", "input": "validation_ok", "format": "PARQUET", "saveMode": "overwrite",
                   "paths": [f"{out}/ok"]},
                  {"name": "ko", "input": "validation_ko", "format": "JSON", "saveMode": "overwrite",
                   "paths": [f"{out}/ko1", f"{out}/ko2"]}]}]}
    sc = spark.sparkContext
    sc.setJobGroup("dqflow-jobs", "jobs per run")
    try:
        res = run(spark, doc, run_id="j")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    st = sc.statusTracker()
    names = [st.getStageInfo(st.getJobInfo(j).stageIds[0]).name for j in st.getJobIdsForGroup("dqflow-jobs")]
    # one job per sink path; the only other job is Parquet's footer read for the schema
    assert sum(n.startswith("save") for n in names) == 3
    assert all(n.startswith("save") or n.startswith("load") for n in names)
    rows = {r.path.rsplit("/", 1)[-1]: r.rows for r in res.flow().sinks}
    assert rows["ko1"] == rows["ko2"] and rows["ok"] + rows["ko1"] == read_table(spark, SF_SMALL, "lineitem").count()


FORBIDDEN_NODES = (
    "CartesianProduct",          # all pairs
    "BroadcastNestedLoopJoin",   # all pairs, one side broadcast unchecked
    "BatchEvalPython",           # row-at-a-time Python UDF
    "ArrowEvalPython",           # Python in the hot path
    "FlatMapGroupsInPandas",     # a whole group in one Python call
    "MapInPandas",
)


def test_registered_queries_plan_hygiene(spark):
    import __spark_entry__ as entry

    bad = {}
    llm = set(entry._llm().queries()) if entry._llm() else set()  # these have tests of their own
    for name, fn in entry.queries().items():
        if name in llm:
            continue
        text = plan(fn(spark, SF_SMALL), "formatted")
        hits = [n for n in FORBIDDEN_NODES if n in text]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_no_rule_lies_under_a_lambda(spark):
    """What lies under a lambda is interpreted row by row: rules must stand beside it."""
    import re

    res = validate(read_table(spark, SF_SMALL, "lineitem"), LINE_RULES)
    for df in (res.ok, res.ko, res.annotated()):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        under = re.findall(r"(?:forall|exists|filter|transform|aggregate)\((.*?)lambdafunction", text)
        assert under and all(re.fullmatch(r"array\(\w+#\d+L?\), ", u) for u in under), under


@pytest.mark.parametrize("limits", [{}, {"max_errors_per_field": 2}, {"max_errors_per_row": 3}, {"max_errors_per_field": 1, "max_errors_per_row": 9}])
def test_look_up_tables_report_what_failed(spark, limits):
    """Fields with fewer rules than a table holds, with more, and several tables, against the labels put together by hand."""
    df = spark.createDataFrame([(i % 11, i % 7, f"v{i}" if i % 5 else None) for i in range(60)], "a int, b int, c string")
    rules = [{"field": "b", "validations": [{"type": "greaterThan", "value": k, "message": f"b;\"{k}\" über"} for k in range(2)]},
             {"field": "a", "validations": [{"type": "greaterThan", "value": k, "message": f"a {k}"} for k in range(17)]},
             {"field": "c", "validations": ["notNull", {"type": "maxLength", "value": 2, "message": " "}]}]
    res = validate(df, rules, keep_array=True, **limits)
    checks = [("b", f"b;\"{k}\" über", lambda r, k=k: r.b > k) for k in range(2)] + [("a", f"a {k}", lambda r, k=k: r.a > k) for k in range(17)]
    checks += [("c", "c:notNull", lambda r: r.c is not None), ("c", " ", lambda r: r.c is not None and len(r.c) <= 2)]
    rows = res.ko.collect()
    assert len(rows) == sum(any(not ok(r) for _, _, ok in checks) for r in df.collect())
    for r in rows:
        failed = [(f, label) for f, label, ok in checks if not ok(r)]
        per, most = limits.get("max_errors_per_field") or 99, limits.get("max_errors_per_row") or 99
        want = {f: [x for g, x in failed if g == f][:per] for f, _ in failed}
        labels = [x for _, x in failed]
        more = f"; ... (+{len(labels) - most} more)" if len(labels) > most else ""
        assert r.validation_errors == want and r.validation_errors_array == labels
        assert r.validation_errors_text == "; ".join(labels[:most]) + more


def test_few_duplicated_keys_leave_the_rows_where_they_are(spark):
    """The set of duplicated keys is measured before the rows are planned: a small one is broadcast, and no row is shuffled."""
    rows = spark.range(40_000, numPartitions=4).selectExpr("CASE WHEN id % 1000 = 0 THEN 7 ELSE id END AS k", "repeat('x', 500) AS payload")
    res = validate(rows, [{"field": "k", "validations": ["unique"]}])
    for df, n in ((res.ok, 39_959), (res.ko, 41)):
        assert len(df.collect()) == n
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
        shuffled = [line for line in final.splitlines() if " Exchange hashpartitioning" in line]
        assert shuffled and not any("payload" in line or "__dq_salt" in line for line in shuffled)


def test_scratch_is_cleared(spark):
    import os

    from dqflow.session import clear_scratch, scratch_path

    other = spark.newSession()  # what other sessions made stays
    path, kept = scratch_path(other, "a"), scratch_path(spark, "b")
    for p in (path, kept):
        spark.range(3).write.parquet(p)
    assert clear_scratch(other) == 1 and clear_scratch(other) == 0
    local = lambda p: p.removeprefix("file:")
    assert not os.path.exists(local(path)) and os.path.exists(local(kept))
