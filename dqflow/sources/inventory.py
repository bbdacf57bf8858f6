"""Source inventory - rows and bytes per input file.

Re-aims the scheduler's "does the source exist / how big is it" checks as a
Spark job.  Files are listed with Spark's ``binaryFile`` source (path and length
only, no content), so files without a row count too; row counts come from the
hidden ``_metadata`` columns of the source itself.
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqflow.sources.reader import read_source


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of every data file under a path; nothing is read but the listing."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def file_inventory(df: DataFrame) -> DataFrame:
    """``(file_path, file_size, rows)`` for one file-based DataFrame."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def source_inventory(sources: Mapping[str, DataFrame]) -> DataFrame:
    """``(source, file_path, file_size, rows)`` over several named sources."""
    parts = [file_inventory(df).select(F.lit(name).alias("source"), "*") for name, df in sources.items()]
    if not parts:
        raise ValueError("source_inventory needs at least one source")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CHECK_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("exists", T.BooleanType()),
    T.StructField("files", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("rows", T.LongType()),
])


def check_sources(spark: SparkSession, document: Mapping[str, Any], count_rows: bool = True) -> DataFrame:
    """Per source of every dataflow: exists, files, bytes, rows.

    The scheduler's "is the source there and how big is it" step.  A path that is not
    there is reported with ``exists = false``; any other failure to list or read a source
    is raised.  ``count_rows=False`` only lists files (``rows`` is NULL): counting the rows
    of CSV or JSON parses the whole source.
    """
    parts = []
    for flow in document.get("dataflows") or []:
        for src in flow.get("sources") or []:
            name, fmt, path = src.get("name"), str(src.get("format", "")).lower(), str(src.get("path"))
            try:
                files = data_files(spark, path)
            except AnalysisException as exc:
                if exc.getCondition() != "PATH_NOT_FOUND":
                    raise
                parts.append(spark.createDataFrame([(name, fmt, path, False, 0, 0, 0 if count_rows else None)], CHECK_SCHEMA))
                continue
            found = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))
            found = found.withColumn("rows", _rows(spark, src) if count_rows else F.lit(None).cast("long"))
            parts.append(found.select(F.lit(name).alias("name"), F.lit(fmt).alias("format"), F.lit(path).alias("path"),
                                      (F.col("files") > 0).alias("exists"), "files", "bytes", "rows"))
    if not parts:
        raise ValueError("the document names no sources")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rows(spark: SparkSession, src: Mapping[str, Any]):
    """The number of rows of a source, as a scalar subquery."""
    try:
        return read_source(spark, src).agg(F.count(F.lit(1)).alias("rows")).scalar()
    except RuntimeError as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):  # no file to infer from: no rows
            return F.lit(0).cast("long")
        raise
