"""Table steps T1-T6, T8 checks, X5 registry and the SQL expression surface."""

import pytest
from pyspark.sql import functions as F

from dqflow import ExecutionError, StepContext, ValidationError, apply_transform, register_transform
from dqflow.operators.transforms import list_transforms


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 10, "x"), (2, "b", None, "y"), (3, "c", 30, "x")],
                                 "id int, name string, age int, grp string")


def step(t, df, **params):
    return apply_transform(t, df, params, StepContext(run_id="t"))


def test_filter_rows(df):
    assert [r.id for r in step("filter_rows", df, condition="age >= 20").collect()] == [3]
    assert step("filter_rows", df, condition="age <> 10").count() == 1  # NULL drops


def test_derive_column_new_and_replace(df):
    out = step("derive_column", df, column="band", expression="CASE WHEN age >= 20 THEN 'hi' ELSE 'lo' END")
    assert out.columns == df.columns + ["band"]
    rep = step("derive_column", df, column="name", expression="upper(name)")
    assert rep.columns == df.columns  # D4: replaced, not duplicated
    assert [r.name for r in rep.orderBy("id").collect()] == ["A", "B", "C"]
    spaced = step("derive_column", df, column="my col", expression="id * 2")
    assert "my col" in spaced.columns


def test_derive_window_and_generator(df):
    w = step("derive_column", df, column="rn", expression="row_number() OVER (PARTITION BY grp ORDER BY id)")
    assert {(r.id, r.rn) for r in w.collect()} == {(1, 1), (3, 2), (2, 1)}
    e = step("derive_column", df, column="x", expression="explode(array(name, grp))")
    assert e.count() == 6


def test_select_rename_drop(df):
    assert step("select_columns", df, columns=["name", "id"]).columns == ["name", "id"]
    assert step("rename_columns", df, mappings={"name": "n", "n": "m", "zz": "q"}).columns == ["id", "m", "age", "grp"]
    assert step("drop_columns", df, columns=["age", "nope"]).columns == ["id", "name", "grp"]


def test_add_fields_fixed_timestamp(df, spark):
    out = step("add_fields", df, addFields=[{"name": "ts", "function": "current_timestamp"}])
    first = {r.ts for r in out.collect()}
    second = {r.ts for r in out.collect()}
    assert len(first) == 1 and first == second  # one literal per run (D9)
    assert dict(out.dtypes)["ts"] == "timestamp"


@pytest.mark.parametrize("t,params", [
    ("filter_rows", {}),
    ("filter_rows", {"condition": ""}),
    ("derive_column", {"column": "x"}),
    ("select_columns", {"columns": "id"}),
    ("rename_columns", {"mappings": ["a"]}),
    ("drop_columns", {"columns": []}),
    ("add_fields", {"addFields": [{"name": "x", "function": "now"}]}),
    ("add_fields", {"addFields": [{"function": "current_timestamp"}]}),
    ("validate_fields", {}),
])
def test_parameter_errors(df, t, params):
    with pytest.raises(ValidationError):
        apply_transform(t, df, params)


def test_unknown_type_lists_available(df):
    with pytest.raises(ValueError, match="known types: add_fields"):
        apply_transform("nope", df, {})


def test_bad_sql_is_execution_error(df):
    with pytest.raises(ExecutionError):
        step("filter_rows", df, condition="no_such_col > 1")


def test_register_transform(df):
    @register_transform("double_age")
    def double_age(d, params, ctx):
        return d.withColumn("age", F.col("age") * params.get("factor", 2))

    assert "double_age" in list_transforms()
    assert [r.age for r in step("double_age", df, factor=3).orderBy("id").collect()] == [30, None, 90]


def test_filter_with_subquery(df):
    out = step("filter_rows", df, condition="id IN (SELECT id FROM range(2))")
    assert [r.id for r in out.collect()] == [1]


def test_placeholder_resolution():
    from dqflow.plans.cli import resolve_placeholders

    env = {"BASE": "/data", "RUN": "r1"}
    doc = {"path": "${BASE}/in.json", "paths": ["${BASE}/out/${RUN}", "${MISSING}/x"], "n": 3, "nested": {"v": "${RUN}"}}
    out = resolve_placeholders(doc, env)
    assert out == {"path": "/data/in.json", "paths": ["/data/out/r1", "${MISSING}/x"], "n": 3, "nested": {"v": "r1"}}


def test_select_star_and_struct_paths(spark):
    df = spark.createDataFrame([(1, (2, "x"))], "id int, s struct<a:int,b:string>")
    assert step("select_columns", df, columns=["*"]).columns == ["id", "s"]
    out = step("select_columns", df, columns=["s.b", "id"])
    assert out.columns == ["b", "id"] and out.first().b == "x"
