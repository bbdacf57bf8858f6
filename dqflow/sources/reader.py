"""Sources (S1-S9): one generic reader over ``DataFrameReader``.

A source spec is ``{name, format, path, options, schema}``.  Reading is
lazy: nothing is scanned until a sink writes, so filters and projections of
later steps reach the scan (Parquet/ORC ``PushedFilters``, ``ReadSchema``).
``schema`` (a DDL string) skips the inference pass JSON and CSV otherwise
need (O12).  Row counts are not taken here; the dataflow attaches an
``Observation`` where counting is free (S9).
"""

from __future__ import annotations

import weakref
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession


def read_source(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """Load ``spec['path']`` with any format Spark knows."""
    if not isinstance(spec, Mapping):
        raise TypeError("a source spec is a dict")
    name = spec.get("name", "unnamed")
    path = spec.get("path")
    fmt = spec.get("format")
    options = spec.get("options") or {}
    schema = spec.get("schema")
    if not path:
        raise ValueError(f"source {name!r}: 'path' is required")
    if not fmt:
        raise ValueError(f"source {name!r}: 'format' is required")
    if not isinstance(options, Mapping):
        raise TypeError(f"source {name!r}: 'options' must be a dict")
    try:
        reader = spark.read.format(str(fmt).lower())
        if options:  # S6
            reader = reader.options(**{k: _opt(v) for k, v in options.items()})
        if schema:
            reader = reader.schema(schema)
        return reader.load(path)
    except Exception as exc:
        raise RuntimeError(f"source {name!r} could not be read as {fmt} from {path}: {exc}") from exc


def _opt(v: Any) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


# Resolved table frames per session: a DataFrame is an immutable plan, so one
# resolution (schema from the Parquet footers, file listing) serves every query.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, base_dir: str, table: str) -> DataFrame:
    """A Parquet table ``<base_dir>/<table>.parquet`` of an immutable table directory.

    The table is resolved once per session, so later reads start no
    schema-inference job; filters and projections still reach the scan.
    """
    path = f"{base_dir.rstrip('/')}/{table}.parquet"
    tables = _TABLES.setdefault(spark, {})
    if path not in tables:
        tables[path] = read_source(spark, {"name": table, "format": "parquet", "path": path})
    return tables[path]
