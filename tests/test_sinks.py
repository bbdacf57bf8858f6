"""Sinks K1-K13, versions and source inventory."""

import os

import pytest

from dqflow import validate
from dqflow.errors import SinkError
from dqflow.sinks.writer import latest_version, list_versions, make_run_id, read_latest, read_version, write_sink
from dqflow.sources.inventory import file_inventory
from dqflow.sources.reader import read_source


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "x")], "id int, name string, grp string")


def spec(path, fmt="parquet", mode="overwrite", **kw):
    return {"name": "s", "format": fmt, "saveMode": mode, "paths": [str(path)], **kw}


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_roundtrip(spark, frame, tmp_path, fmt):
    opts = {"header": "true"} if fmt == "csv" else {}
    res = write_sink(frame, spec(tmp_path / fmt, fmt, options=opts))
    assert res[0].rows == 3
    back = read_source(spark, {"name": "b", "format": fmt, "path": str(tmp_path / fmt), "options": opts,
                               "schema": "id int, name string, grp string"})
    assert sorted(back.collect()) == sorted(frame.collect())


def test_modes(spark, frame, tmp_path):
    p = tmp_path / "m"
    write_sink(frame, spec(p, mode="ERRORIFEXISTS"))  # fresh path: no pre-created directory (D6)
    with pytest.raises(SinkError):
        write_sink(frame, spec(p, mode="errorifexists"))
    write_sink(frame, spec(p, mode="IGNORE"))
    assert spark.read.parquet(str(p)).count() == 3
    write_sink(frame, spec(p, mode="Append"))
    assert spark.read.parquet(str(p)).count() == 6
    write_sink(frame.limit(1), spec(p, mode="OVERWRITE"))
    assert spark.read.parquet(str(p)).count() == 1
    with pytest.raises(ValueError):
        write_sink(frame, spec(p, mode="sometimes"))


def test_multi_path_and_partitioned(spark, frame, tmp_path):
    res = write_sink(frame, {"name": "m", "format": "parquet", "saveMode": "overwrite",
                             "paths": [str(tmp_path / "a"), str(tmp_path / "b")], "partitionBy": ["grp"]})
    assert [r.rows for r in res] == [3, 3]
    assert {"_SUCCESS", "grp=x", "grp=y"} <= set(os.listdir(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "b")).filter("grp = 'x'").count() == 2
    with pytest.raises(ValueError):
        write_sink(frame.select("grp"), spec(tmp_path / "c", partitionBy=["grp"]))
    with pytest.raises(ValueError):
        write_sink(frame, {"name": "x", "format": "parquet", "saveMode": "overwrite", "paths": [""]})
    with pytest.raises(TypeError):
        write_sink(frame, spec(tmp_path / "d", partitionBy="grp"))


def test_csv_and_text_take_nested_values(spark, frame, tmp_path):
    ko = validate(frame, [{"field": "name", "validations": ["notNull"]}]).ko
    write_sink(ko, spec(tmp_path / "csv", "csv", options={"header": True}))
    row = spark.read.option("header", "true").csv(str(tmp_path / "csv")).first()
    assert row.validation_errors == '{"name":["name:notNull"]}'
    write_sink(ko, spec(tmp_path / "txt", "text"))
    assert '"validation_errors_text":"name:notNull"' in spark.read.text(str(tmp_path / "txt")).first().value


def test_json_sink_omits_nulls(spark, frame, tmp_path):
    write_sink(frame, spec(tmp_path / "j", "json"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert '{"id":3,"grp":"x"}' in lines


def test_versioned_latest_and_manifest(spark, frame, tmp_path):
    base = str(tmp_path / "v")
    s = spec(base, versioning={"enabled": True})
    write_sink(frame.limit(1), s, run_id="run-1")
    write_sink(frame, s, run_id="run/2 x")
    assert latest_version(spark, base)["version_id"] == "run_2_x"
    assert read_latest(spark, base).count() == 3
    assert read_version(spark, base, "run-1", "parquet").count() == 1
    assert read_version(spark, base, "run-1").count() == 1  # format from the manifest
    with pytest.raises(FileNotFoundError):
        read_version(spark, base, "never")
    m = {r.version_id: r.rows for r in list_versions(spark, base).collect()}
    assert m == {"run-1": 1, "run_2_x": 3}
    write_sink(frame.limit(2), s, run_id="run-1")  # same run id again: the version is replaced
    m = {r.version_id: r.rows for r in list_versions(spark, base).collect()}
    assert m == {"run-1": 2, "run_2_x": 3} and latest_version(spark, base)["version_id"] == "run-1"
    assert read_version(spark, base, "run-1").count() == 2
    assert os.path.isdir(f"{base}/_versions/run-1")
    write_sink(frame, spec(tmp_path / "nv", versioning=False))
    assert not os.path.exists(tmp_path / "nv" / "_versions")


def test_run_id():
    assert make_run_id("a b/c..") == "a_b_c"
    rid = make_run_id()
    assert len(rid) == 16 and rid.endswith("Z") and "T" in rid


def test_source_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        read_source(spark, {"name": "x", "format": "json"})
    with pytest.raises(ValueError):
        read_source(spark, {"name": "x", "path": "/nope"})
    with pytest.raises(TypeError):
        read_source(spark, "not a dict")
    with pytest.raises(RuntimeError):
        read_source(spark, {"name": "x", "format": "parquet", "path": str(tmp_path / "missing")})


def test_file_inventory(spark):
    inv = file_inventory(spark.read.parquet("/root/testdata/sf0.001/region.parquet")).collect()
    assert len(inv) == 1 and inv[0].rows == 5 and inv[0].file_size > 0


def test_files_option(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=8).selectExpr("id", "id % 3 AS g")
    write_sink(df, spec(tmp_path / "f", files=2))
    parts = [f for f in os.listdir(tmp_path / "f") if f.startswith("part-")]
    assert len(parts) == 2 and spark.read.parquet(str(tmp_path / "f")).count() == 1000
    with pytest.raises(ValueError):
        write_sink(df, spec(tmp_path / "g", files=0))


def test_partition_pruning_on_read_back(spark, frame, tmp_path):
    write_sink(frame, spec(tmp_path / "p", partitionBy=["grp"]))
    df = read_source(spark, {"name": "p", "format": "parquet", "path": str(tmp_path / "p")}).filter("grp = 'x'")
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "PartitionFilters: [isnotnull(grp" in buf.getvalue() and df.count() == 2


def test_check_sources_reports_missing(spark, tmp_path):
    from dqflow.sources import check_sources

    doc = {"dataflows": [{"name": "x", "sources": [
        {"name": "region", "format": "PARQUET", "path": "/root/testdata/sf0.001/region.parquet"},
        {"name": "gone", "format": "JSON", "path": str(tmp_path / "missing.json")}]}]}
    rows = {r.name: r for r in check_sources(spark, doc).collect()}
    assert rows["region"].exists and rows["region"].rows == 5 and rows["region"].bytes > 0
    assert rows["gone"].exists is False and rows["gone"].rows == 0


def test_multi_path_rereads_committed_output(spark, tmp_path):
    """Later paths come from the first committed Parquet output: same rows, types and column order."""
    df = spark.createDataFrame([(1, "a", 1.5, [1, 2]), (2, None, None, None)], "id int, s string, x double, arr array<int>")
    res = write_sink(df, {"name": "m", "format": "parquet", "saveMode": "overwrite", "partitionBy": ["s"],
                          "paths": [str(tmp_path / "a"), str(tmp_path / "b")]})
    assert [r.rows for r in res] == [2, 2]
    back = spark.read.parquet(str(tmp_path / "b")).select(*df.columns)
    assert sorted(back.collect()) == sorted(df.collect()) and back.dtypes == df.dtypes
    # appending targets are never re-read (they may hold older rows): persisted instead
    write_sink(df, {"name": "m2", "format": "parquet", "saveMode": "append",
                    "paths": [str(tmp_path / "a"), str(tmp_path / "c")]})
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_ko_frame_roundtrip_with_nested_report(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, None, "7"), (2, "", "x"), (3, "ok", "5")], "id int, a string, b string")
    ko = validate(df, [{"field": "a", "validations": ["notNull", "notEmpty"]},
                       {"field": "b", "validations": ["integer"]}], keep_array=True).ko
    write_sink(ko, spec(tmp_path / fmt, fmt))
    back = spark.read.schema(ko.schema).format(fmt).load(str(tmp_path / fmt))

    def norm(rows):
        return sorted((r.id, r.a, r.b, sorted((k, list(v)) for k, v in r.validation_errors.items()),
                       r.validation_errors_text, list(r.validation_errors_array)) for r in rows)

    assert norm(back.collect()) == norm(ko.collect())


def test_inventory_over_several_sources(spark, tmp_path):
    from dqflow.sources import check_sources, source_inventory

    csv = tmp_path / "c.csv"
    csv.write_text("id;v\n1;a\n2;b\n3;c\n")
    sources = {"region": spark.read.parquet("/root/testdata/sf0.001/region.parquet"),
               "nation": spark.read.parquet("/root/testdata/sf0.001/nation.parquet")}
    inv = {r.source: r.rows for r in source_inventory(sources).collect()}
    assert inv == {"region": 5, "nation": 25}
    doc = {"dataflows": [{"name": "c", "sources": [
        {"name": "c", "format": "CSV", "path": str(csv), "options": {"header": True, "delimiter": ";"}}]}]}
    row = check_sources(spark, doc).first()
    assert (row.name, row.format, row.exists, row.files, row.rows) == ("c", "csv", True, 1, 3)


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    from dqflow.session import checkpoint_dir, scratch_path

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    base = checkpoint_dir(spark)
    if configured:  # the cluster's shared folder is used, not a private temp folder
        assert configured.rstrip("/").split(":")[-1] in base
    p1, p2 = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert p1 != p2 and p1.startswith(base.rstrip("/") + "/dqflow-t-")
