"""Dataflows (X1-X5, E5): named sources -> ordered steps -> sinks.

``run(spark, spec)`` turns a JSON-like document into lazy DataFrames held in
a name -> DataFrame registry, then writes the sinks.  The only Spark jobs are
the sink writes, one per path; a frame feeding several paths is computed once
(later paths re-read the first committed Parquet/ORC output, or the frame is
persisted).  Row counts for the run report and a validate step's metrics come
from ``Observation``s collected by those writes (X4), not from extra jobs.

Every step has exactly one input, but any earlier name may be that input,
so a list of steps expresses a tree of tables (fan-out).  ``run`` stores a
table that feeds several branches where making it again would cost more than
keeping it (X2, K12): below a source whose rows must be parsed (JSON, CSV,
text, anything but Parquet and ORC), or a step of the user's own that shuffles or
runs Python.  A validate step whose accepted and rejected rows are both wanted is such a table: it is
evaluated once and split.  Branches over a columnar source read it again, each
with its own pushed filters and columns, which is less than any stored copy.
"""

from __future__ import annotations

import logging
import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Mapping

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqflow.operators.transforms import StepContext, apply_transform, list_transforms
from dqflow.operators.validation import ValidationResult
from dqflow.sinks.writer import SinkResult, can_anchor, make_run_id, read_back, write_sink
from dqflow.sources.reader import read_source

OK_NAME, KO_NAME = "validation_ok", "validation_ko"

log = logging.getLogger("dqflow")

# Sources that are cheap to read again: filters and columns reach the scan, and a count reads footers only.
COLUMNAR_FORMATS = frozenset({"parquet", "orc"})
BUILT_IN = frozenset(list_transforms())
# What makes a table costly to compute again.
_HEAVY_NODES = re.compile(r"\b(Aggregate|Join|Window|Sort|Distinct|Deduplicate|Repartition\w*|\w*Python\w*|MapIn\w+|\w*InPandas\w*|\w*InArrow\w*)\b")

# Sink writes of different tables that may run at the same time.
DEFAULT_PARALLEL_SINKS = 4


@dataclass
class FlowResult:
    name: str
    tables: dict[str, DataFrame]
    validations: dict[str, ValidationResult] = field(default_factory=dict)
    sinks: list[SinkResult] = field(default_factory=list)
    observed: dict[str, Observation] = field(default_factory=dict)
    parents: dict[str, str | None] = field(default_factory=dict)
    kinds: dict[str, str] = field(default_factory=dict)
    metric_tables: dict[str, tuple[str, str]] = field(default_factory=dict)  # name -> (step, "stats"|"failures")
    scans: dict[str, DataFrame] = field(default_factory=dict)  # sources whose rows are counted from their footers
    stored: dict[str, DataFrame | None] = field(default_factory=dict)  # tables kept for their branches (None: by the step)

    def release(self) -> None:
        for v in self.validations.values():
            v.release()
        for df in self.stored.values():
            if df is not None:
                df.unpersist()


@dataclass
class RunResult:
    run_id: str
    run_timestamp: datetime
    flows: list[FlowResult]

    def flow(self, name: str | None = None) -> FlowResult:
        if name is None:
            return self.flows[0]
        return next(f for f in self.flows if f.name == name)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per written sink path (and per observed table)."""
        rows = []
        for f in self.flows:
            for s in f.sinks:
                rows.append((self.run_id, f.name, "sink", s.sink, s.path, s.version_id, s.rows))
            written = _ancestors(f, {s.input for s in f.sinks if s.rows is not None})
            for tname in [n for n in f.tables if n in f.observed or n in f.scans]:
                rows_seen = None
                if tname in written:
                    rows_seen = f.scans[tname].count() if tname in f.scans else int(f.observed[tname].get.get("rows", 0))
                rows.append((self.run_id, f.name, f.kinds.get(tname, "table"), tname, None, None, rows_seen))
        schema = T.StructType([
            T.StructField("run_id", T.StringType()),
            T.StructField("dataflow", T.StringType()),
            T.StructField("kind", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("version_id", T.StringType()),
            T.StructField("rows", T.LongType()),
        ])
        return spark.createDataFrame(rows, schema)


def _ancestors(flow: FlowResult, names: set[str]) -> set[str]:
    seen: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n in seen or n is None:
            continue
        seen.add(n)
        todo.append(flow.parents.get(n))
    return seen


_SUFFIXES = ("ok", "ko", "all", "stats", "failures")


def _check_steps(flow: Mapping[str, Any]) -> set[str]:
    """Steps in order: required fields, known types, unique names, inputs defined earlier.

    Returns every table name the dataflow can define.  A validate step takes its derived
    names too, whether or not they are read, so no other table can hide one of them."""
    defined: set[str] = set()
    for src in flow.get("sources") or []:
        name = src.get("name") if isinstance(src, Mapping) else None
        if not name:
            raise ValueError("every source needs a name")
        if name in defined:
            raise ValueError(f"source name {name!r} is used twice")
        if name in (OK_NAME, KO_NAME):
            raise ValueError(f"table name {name!r} is kept for validate steps")
        defined.add(name)
    for step in flow.get("transformations") or []:
        if not isinstance(step, Mapping):
            raise TypeError("every step in 'transformations' is a dict")
        stype, sname = step.get("type"), step.get("name")
        input_name = (step.get("params") or {}).get("input")
        if not stype:
            raise ValueError(f"step {sname!r} has no 'type'")
        if not sname:
            raise ValueError(f"a {stype!r} step has no 'name'; every step needs one")
        if stype not in list_transforms():
            raise ValueError(f"step {sname!r}: no step type {stype!r}; known types: {', '.join(list_transforms())}")
        if not input_name:
            raise ValueError(f"step {sname!r} ({stype}) names no 'params.input'")
        if input_name not in defined:
            raise KeyError(f"step {sname!r} reads {input_name!r}, which is not defined before it; "
                           f"known tables: {sorted(defined)}")
        takes = {sname}
        if stype == "validate_fields":
            takes |= {f"{sname}_{suffix}" for suffix in _SUFFIXES}
        for name in sorted(takes):
            if name in defined or name in (OK_NAME, KO_NAME):
                raise ValueError(f"step {sname!r}: table name {name!r} is already taken")
        defined |= takes
        if stype == "validate_fields":
            defined |= {OK_NAME, KO_NAME}
    return defined


def _check_document(spec: Any) -> list[Mapping[str, Any]]:
    """Structure checks before anything is read."""
    if not isinstance(spec, Mapping):
        raise TypeError("a dataflow document is a JSON object (dict)")
    flows = spec.get("dataflows")
    if not isinstance(flows, list) or not flows:
        raise ValueError("the document needs a non-empty list under 'dataflows'")
    for flow in flows:
        if not isinstance(flow, Mapping):
            raise TypeError("every entry of 'dataflows' is a dict")
        if not flow.get("sources"):
            raise ValueError("a dataflow reads at least one source")
        if not flow.get("sinks"):
            raise ValueError("a dataflow writes at least one sink")
        known = _check_steps(flow)
        for sink in flow["sinks"]:
            if isinstance(sink, Mapping) and sink.get("input") not in known:
                raise KeyError(
                    f"sink {sink.get('name', 'unnamed')!r} writes {sink.get('input')!r}, which no source or step "
                    f"defines; known tables: {sorted(known)}"
                )
    return flows


def _observe(flow: FlowResult, name: str, df: DataFrame) -> DataFrame:
    obs = Observation(f"dqflow_{uuid.uuid4().hex}")
    flow.observed[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def _readers(flow_spec: Mapping[str, Any]) -> dict[str, int]:
    """How many steps and sinks read each table; the accepted and rejected rows of a validate step
    count as reads of the step, by the names ``<step>_ok`` and ``<step>_ko``."""
    readers: dict[str, int] = {}
    last = None
    steps = [st for st in flow_spec.get("transformations") or [] if isinstance(st, Mapping)]
    for step in [*steps, *[{"params": {"input": sk.get("input")}} for sk in flow_spec.get("sinks") or [] if isinstance(sk, Mapping)]]:
        name = (step.get("params") or {}).get("input")
        name = {OK_NAME: f"{last}_ok", KO_NAME: f"{last}_ko"}.get(name, name) if last else name
        readers[name] = readers.get(name, 0) + 1
        if step.get("type") == "validate_fields":
            last = step["name"]
    return readers


def _heavy(df: DataFrame) -> bool:
    """Whether a table's plan, above its scans, shuffles rows or runs Python."""
    jdf = getattr(df, "_jdf", None)  # a Spark Connect frame has no plan to ask
    return jdf is not None and bool(_HEAVY_NODES.search(jdf.queryExecution().analyzed().toString()))


def build_flow(
    spark: SparkSession,
    flow_spec: Mapping[str, Any],
    ctx: StepContext,
    *,
    observe_tables: bool = False,
    share: str = "none",
) -> FlowResult:
    """Build the registry of lazy DataFrames for one dataflow.

    No job runs but those that a step itself needs: schema inference of a source, and the
    checkpoint of a validate step whose input or rules are not deterministic.
    ``observe_tables`` counts the rows of every source and step output (S9): of a columnar
    source from its footers, when the report is made, so that filters still reach its scan; of other
    sources and of steps by an ``Observation`` on the table.  It is off by default: the count
    of a step's rows keeps later filters above that step.
    ``share="auto"`` marks costly tables that feed several branches to be stored when they
    are first computed; ``FlowResult.release`` frees them.
    """
    flow = FlowResult(flow_spec.get("name", "unnamed"), {})
    tables = flow.tables
    sink_inputs = {sk.get("input") for sk in flow_spec.get("sinks") or [] if isinstance(sk, Mapping)}
    referenced = sink_inputs | {
        (st.get("params") or {}).get("input") for st in flow_spec.get("transformations") or [] if isinstance(st, Mapping)
    }

    _check_steps(flow_spec)
    readers = _readers(flow_spec) if share == "auto" else {}
    costly: dict[str, bool] = {}

    def shared(name: str, df: DataFrame) -> DataFrame:
        """``df``, stored if it is costly and feeds several branches (several sinks alone share it when they write)."""
        steps = sum((st.get("params") or {}).get("input") == name for st in flow_spec.get("transformations") or [])
        if costly[name] and steps and readers.get(name, 0) > 1:
            flow.stored[name], costly[name] = df.persist(StorageLevel.MEMORY_AND_DISK), False
        return df

    for src in flow_spec.get("sources", []):  # S8
        name = src["name"]
        try:
            df = read_source(spark, src)
        except Exception as exc:
            raise KeyError(f"source {name!r} could not be loaded: {exc}") from exc
        columnar = str(src.get("format")).lower() in COLUMNAR_FORMATS
        if observe_tables and columnar:
            flow.scans[name] = df
        elif observe_tables:
            df = _observe(flow, name, df)
        costly[name] = not columnar
        tables[name] = shared(name, df)
        flow.parents[name], flow.kinds[name] = None, "source"
        log.info("source %s: %s %s", name, src.get("format"), src.get("path"))

    for step in flow_spec.get("transformations", []) or []:  # X1/X2, checked above
        stype, sname, params = step["type"], step["name"], step["params"]
        input_name = params["input"]
        if stype == "validate_fields" and "observe" not in params and (
                {f"{sname}_stats", f"{sname}_failures"} & sink_inputs):
            # metrics are written: let the KO branch count them while it scans
            params = {**params, "observe": True}
        costly[sname] = costly[input_name]
        split = stype == "validate_fields" and all(readers.get(f"{sname}_{x}") for x in ("ok", "ko"))
        if split and costly[sname] and "materialize" not in params:  # K12: evaluated once for both outputs
            params = {**params, "materialize": "persist"}
            flow.stored[sname], costly[sname] = None, False
        try:
            result = apply_transform(stype, tables[input_name], params, ctx)
        except Exception as exc:  # name the step in whatever went wrong
            raise RuntimeError(f"step {sname!r} ({stype}) failed: {exc}") from exc
        log.info("step %s (%s) <- %s", sname, stype, input_name)
        if isinstance(result, ValidationResult):  # D5
            flow.validations[sname] = result
            ok, ko = result.ok, result.ko
            if observe_tables:
                ok, ko = _observe(flow, f"{sname}_ok", ok), _observe(flow, f"{sname}_ko", ko)
            links = ((f"{sname}_ok", ok, input_name), (f"{sname}_ko", ko, input_name),
                     (OK_NAME, ok, f"{sname}_ok"), (KO_NAME, ko, f"{sname}_ko"))
            for alias, frame, parent in links:
                tables[alias], costly[alias] = frame, costly[sname]
                flow.parents[alias], flow.kinds[alias] = parent, "validation"
            if result.compiled is not None and result.compiled.rules:
                # quality metrics as tables, built only when a sink or step reads them
                # (always available as flow.validations[step].stats() / .failures_by_rule())
                for alias, build in ((f"{sname}_stats", result.stats), (f"{sname}_failures", result.failures_by_rule)):
                    if alias in referenced:
                        tables[alias], costly[alias] = build(), True
                        flow.parents[alias], flow.kinds[alias] = input_name, "metrics"
                        flow.metric_tables[alias] = (sname, alias.rsplit("_", 1)[1])
                if f"{sname}_all" in referenced:  # every row, flagged: one scan for both outputs
                    tables[f"{sname}_all"], costly[f"{sname}_all"] = result.annotated(), costly[sname]
                    flow.parents[f"{sname}_all"], flow.kinds[f"{sname}_all"] = input_name, "validation"
        else:
            costly[sname] = costly[sname] or stype not in BUILT_IN and _heavy(result)
            tables[sname] = shared(sname, _observe(flow, sname, result) if observe_tables else result)
            flow.parents[sname], flow.kinds[sname] = input_name, "step"
    return flow


def _leaders(flow: FlowResult, groups: dict[int, list[tuple[int, Mapping[str, Any]]]]) -> list[int]:
    """For each stored table the first group of sinks below it: they run before the others, so that the table is
    computed once and not by several jobs side by side."""
    out: list[int] = []
    for name in flow.stored:
        below = {name, f"{name}_ok", f"{name}_ko"}
        key = next((k for k, items in groups.items() if below & _ancestors(flow, {items[0][1]["input"]})), None)
        if key is not None and key not in out:
            out.append(key)
    return out


def write_flow(
    flow: FlowResult,
    sinks: list[Mapping[str, Any]],
    run_id: str,
    *,
    share: str = "auto",
    parallel: int = DEFAULT_PARALLEL_SINKS,
) -> None:
    """Write every sink; a table feeding several paths is computed once.

    If the table's first sink is lossless and fresh (Parquet/ORC, overwrite or
    error mode), later sinks read that committed output back; otherwise the
    table is persisted for the duration of the writes.

    Sinks of different tables are independent jobs and run concurrently (up to
    ``parallel`` at a time, sharing the cluster); the sinks of one table run in
    order, and metrics tables run last, after the KO writes they observe.
    """
    for sink in sinks:
        if not isinstance(sink, Mapping):
            raise TypeError("every sink is a dict")
        if sink.get("input") not in flow.tables:
            raise KeyError(
                f"sink {sink.get('name', 'unnamed')!r} writes {sink.get('input')!r}, which no source or step "
                f"defines; known tables: {list(flow.tables)}"
            )
    # Count paths per frame (not per name: ``validation_ok`` and ``<step>_ok`` are one frame).
    uses: dict[int, int] = {}
    for sink in sinks:
        key = id(flow.tables[sink["input"]])
        uses[key] = uses.get(key, 0) + len(sink.get("paths") or [])
    strategy: dict[int, str] = {}
    shared: dict[int, DataFrame] = {}
    if share == "auto":
        for sink in sinks:
            df = flow.tables[sink["input"]]
            if uses[id(df)] > 1 and id(df) not in strategy:
                strategy[id(df)] = "reread" if can_anchor(sink) else "persist"
                if strategy[id(df)] == "persist":
                    shared[id(df)] = df.persist(StorageLevel.MEMORY_AND_DISK)
    anchors: dict[int, SinkResult] = {}
    written: set[int] = set()
    done: dict[int, list[SinkResult]] = {}
    lock = threading.Lock()

    def write_one(idx: int, sink: Mapping[str, Any]) -> None:
        df = flow.tables[sink["input"]]
        key = id(df)
        src = shared.get(key, df)
        with lock:
            observed = _observed_metrics(flow, sink["input"], written)
            anchor = anchors.get(key)
        if observed is not None:
            src = observed
        if strategy.get(key) == "reread" and anchor is not None:
            src = read_back(df.sparkSession, anchor, df)
        try:
            results = write_sink(src, sink, run_id=run_id, share="none" if key in shared else share)
        except Exception as exc:
            raise RuntimeError(f"sink {sink.get('name', 'unnamed')!r} failed: {exc}") from exc
        with lock:
            if all(r.rows is not None for r in results):  # not a write that was skipped
                written.add(key)
            if strategy.get(key) == "reread" and key not in anchors:
                anchors[key] = results[0]
            done[idx] = results
        for r in results:
            log.info("sink %s <- %s: %s rows to %s", r.sink, r.input, r.rows, r.uri)

    def write_group(items: list[tuple[int, Mapping[str, Any]]]) -> None:
        for idx, sink in items:
            write_one(idx, sink)

    groups: dict[int, list[tuple[int, Mapping[str, Any]]]] = {}
    metrics: list[tuple[int, Mapping[str, Any]]] = []
    for idx, sink in enumerate(sinks):
        if sink["input"] in flow.metric_tables:
            metrics.append((idx, sink))  # last: by then the KO branch they observe has run
        else:
            groups.setdefault(id(flow.tables[sink["input"]]), []).append((idx, sink))
    try:
        for key in _leaders(flow, groups):
            write_group(groups.pop(key))
        if parallel > 1 and len(groups) > 1:
            session = next(iter(flow.tables.values())).sparkSession
            target = inheritable_thread_target(session)(write_group)  # threads keep job group, tags, properties
            with ThreadPoolExecutor(max_workers=min(parallel, len(groups))) as pool:
                futures = [pool.submit(target, items) for items in groups.values()]
            errors = [f.exception() for f in futures]
            first = next((e for e in errors if e is not None), None)
            if first is not None:
                raise first
        else:
            for items in groups.values():
                write_group(items)
        write_group(metrics)
    finally:
        for idx in sorted(done):  # the report keeps the declared sink order
            flow.sinks.extend(done[idx])
        for df in shared.values():
            df.unpersist()
        flow.release()


def _observed_metrics(flow: FlowResult, name: str, written: set[int]) -> DataFrame | None:
    """The metrics table ``name`` from its step's KO-branch observation, if that branch already ran."""
    if name not in flow.metric_tables:
        return None
    step, which = flow.metric_tables[name]
    result = flow.validations[step]
    all_frame = flow.tables.get(f"{step}_all")
    if result.observation is not None and id(flow.tables[f"{step}_ko"]) in written:
        source = "ko"
    elif result.observation_all is not None and all_frame is not None and id(all_frame) in written:
        source = "all"
    else:
        return None
    spark = result.ko.sparkSession
    if which == "stats":
        return result.observed_stats(spark, source)
    return result.observed_failures(spark, source)


def run(
    spark: SparkSession,
    spec: Mapping[str, Any],
    *,
    run_id: str | None = None,
    run_timestamp: datetime | None = None,
    all_dataflows: bool = True,
    write: bool = True,
    observe_tables: bool = False,
    share: str = "auto",
    parallel_sinks: int = DEFAULT_PARALLEL_SINKS,
) -> RunResult:
    """Run a dataflow document.  ``all_dataflows=False`` runs only the first (E5)."""
    flows = _check_document(spec)
    if not all_dataflows:
        flows = flows[:1]
    ts = run_timestamp or datetime.now(timezone.utc)
    rid = make_run_id(run_id, ts)
    ctx = StepContext(run_id=rid, run_timestamp=ts)
    results = []
    for flow_spec in flows:
        flow = build_flow(spark, flow_spec, ctx, observe_tables=observe_tables, share=share if write else "none")
        if write:
            write_flow(flow, list(flow_spec.get("sinks", [])), rid, share=share, parallel=parallel_sinks)
        results.append(flow)
    return RunResult(rid, ts, results)
