"""Command-line entry: run a dataflow document with ``spark-submit``.

    python -m dqflow --config conf.json
    spark-submit --py-files dqflow.zip dqflow/__main__.py --config conf.json

The document may live on any Hadoop-supported path (local, HDFS, object
store); it is read through Spark.  ``${NAME}`` placeholders are replaced by
environment variables (unset ones are left as they are, with a warning).
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
from typing import Any

_PLACEHOLDER = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def resolve_placeholders(value: Any, env: dict[str, str] | None = None) -> Any:
    env = os.environ if env is None else env
    if isinstance(value, str):
        def sub(m: re.Match) -> str:
            if m.group(1) in env:
                return env[m.group(1)]
            print(f"warning: environment variable {m.group(1)} is not set; kept {m.group(0)}", file=sys.stderr)
            return m.group(0)
        return _PLACEHOLDER.sub(sub, value)
    if isinstance(value, list):
        return [resolve_placeholders(v, env) for v in value]
    if isinstance(value, dict):
        return {k: resolve_placeholders(v, env) for k, v in value.items()}
    return value


def load_document(spark, path: str) -> dict:
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            text = f.read()
    else:
        text = spark.read.text(path, wholetext=True).first()[0]
    return resolve_placeholders(json.loads(text))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="dqflow", description="Run a dataflow document on Spark.")
    parser.add_argument("--config", required=True, help="path of the JSON dataflow document")
    parser.add_argument("--run-id", default=None, help="run id for versioned sinks (default: UTC timestamp)")
    parser.add_argument("--first-only", action="store_true", help="run only the first dataflow")
    parser.add_argument("--app-name", default="dqflow", help="Spark application name")
    parser.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    parser.add_argument("--observe-tables", action="store_true", help="report row counts of every table")
    parser.add_argument("--parallel-sinks", type=int, default=4,
                        help="sink writes of different tables that may run at the same time (1 = one by one)")
    parser.add_argument("--explain", action="store_true",
                        help="print the physical plan of every sink input and exit without writing")
    args = parser.parse_args(argv)
    import logging

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")

    from pyspark.sql import SparkSession

    from dqflow.plans.dataflow import run

    builder = SparkSession.builder.appName(args.app_name)
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    try:
        doc = load_document(spark, args.config)
        if args.explain:
            result = run(spark, doc, run_id=args.run_id, all_dataflows=not args.first_only, write=False)
            for flow_spec, flow in zip(doc["dataflows"], result.flows):
                for sink in flow_spec.get("sinks") or []:
                    print(f"== dataflow {flow.name!r}, sink {sink.get('name')!r} <- {sink.get('input')!r} ==")
                    flow.tables[sink["input"]].explain("formatted")
            return 0
        result = run(spark, doc, run_id=args.run_id, all_dataflows=not args.first_only,
                     observe_tables=args.observe_tables, parallel_sinks=args.parallel_sinks)
        result.report(spark).show(truncate=False)
        return 0
    except Exception as exc:  # noqa: BLE001 - command-line boundary
        print(f"dqflow failed: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
