"""``validate_fields`` (T7): split a table into accepted and rejected rows.

Rules are grouped in blocks ``{field, validations: [...], message}``.  Every
rule compiles to a native predicate (``dqflow.functions.rules``); a NULL
predicate counts as a failure (D-1).

Plan shape (``materialize="none"``, the default):

* **OK branch** = ``filter(p1 AND p2 AND ...)``: a plain conjunction.  A NULL
  conjunct already drops the row, so no ``coalesce`` is needed, and Catalyst
  can push every pushable rule (``=``, ``IN``, ``>``, ``IS NOT NULL``,
  ``startsWith`` ...) down to the columnar scan (O4).
* **KO branch** = ``filter(NOT coalesce(p1 AND ..., false))``, then the
  error report is built for the failing rows only (rejected rows are
  usually few, so the labels are evaluated on little data).
* All rules of a branch are compiled in one operator, the filter or the
  projection of the labels, which is kept out of whole-stage codegen, where they
  would become one method too large for the JVM to compile (see ``beside``).

``annotated()`` is the cache-free single pass: every row with ``is_valid`` and
the report (NULL when valid); written with ``partitionBy("is_valid")`` it
yields both outputs from one scan and one job.

``materialize="persist"`` / ``"checkpoint"`` evaluates every rule once per
row into a few bit masks, materialises that annotated frame
(executor storage, or a reliable checkpoint in ``spark.checkpoint.dir``) and
splits it; use it for an expensive upstream (O8).  Where the input or a rule is
not deterministic (``rand()``, ``uuid()``), the two branches must see one
evaluation that survives a lost executor, so ``"checkpoint"`` is used whatever
was asked for (O13).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field as dc_field
from functools import cached_property
from typing import Any, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqflow.errors import InvalidValidationConfig, ValidationException
from dqflow.functions.rules import build_predicate, parse_entry
from dqflow.operators.quality import DEFAULT_ROWS_PER_SALT, flag_duplicates

# ---------------------------------------------------------------------------
# The report's column names, its joiner and truncation wording,
# and the fallback text are part of the output format.
# ---------------------------------------------------------------------------
ERRORS_MAP = "validation_errors"
ERRORS_TEXT = "validation_errors_text"
ERRORS_ARRAY = "validation_errors_array"
UNKNOWN_ERROR = "Unknown validation error"
VALID_FLAG = "is_valid"
JOINER = "; "
MORE_PREFIX, MORE_SUFFIX = "; ... (+", " more)"
DEFAULT_MAX_ERRORS = 0  # no limit: every label is kept

# Columns that hold a row's failed rules, a bit each, while a report is built, and the rules of
# one column (the table of its reports has 2^n entries).
MASK = "__dq_failed"
PART_RULES = 7
# Parts whose look-ups together stay well below the size of method the JVM compiles.
FEW_PARTS = 5

_ERROR_COLS = (ERRORS_MAP, ERRORS_TEXT, ERRORS_ARRAY)


# ---------------------------------------------------------------------------
# Field resolution (D11): top-level names, back-quoted literal names with dots,
# and nested struct paths all resolve; Spark's case-insensitive matching.
# ---------------------------------------------------------------------------

def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _find(fields: Sequence[T.StructField], name: str) -> T.StructField | None:
    for f in fields:
        if f.name == name:
            return f
    low = name.lower()
    hits = [f for f in fields if f.name.lower() == low]
    return hits[0] if len(hits) == 1 else None


def resolve_field(df: DataFrame, name: Any) -> tuple[Column, T.DataType, str]:
    """Return ``(column, data type, SQL reference)`` for a rule's ``field``."""
    if not isinstance(name, str) or not name:
        raise InvalidValidationConfig("a rule block needs a 'field'")
    top = _find(df.schema.fields, name)
    if top is not None:
        ref = quote(top.name)
        return F.col(ref), top.dataType, ref
    dt: T.DataType = df.schema
    parts = []
    for part in name.split("."):
        f = _find(dt.fields, part) if isinstance(dt, T.StructType) else None
        if f is None:
            raise InvalidValidationConfig(f"no column {name!r} to validate; columns: {df.columns}")
        parts.append(quote(f.name))
        dt = f.dataType
    ref = ".".join(parts)
    return F.col(ref), dt, ref


# Relative per-row cost of a rule, used only to order the split filters
# (AND short-circuits, so a cheap failing rule saves the expensive ones).
# Report labels always keep the configured order.
_RULE_COST = {
    "notNull": 0, "unique": 0,
    "notEmpty": 1, "equals": 1, "inList": 1, "positive": 1, "nonNegative": 1, "greaterThan": 1, "lessThan": 1,
    "between": 1, "numeric": 2, "startsWith": 2, "endsWith": 2, "contains": 2,
    "minLength": 2, "maxLength": 2, "lengthBetween": 2,
}
_DEFAULT_COST = 3  # regular expressions, SQL rules, user rules
_PUSHABLE_COST = 1
# Rules that together stay well below the size of method the JVM compiles.
FEW_RULES = 4


def cheap_first(rules: Sequence["CompiledRule"]) -> list["CompiledRule"]:
    return sorted(rules, key=lambda r: (_RULE_COST.get(r.rule, _DEFAULT_COST), r.index))


def all_of(cols: Sequence[Column]) -> Column:
    """AND of many columns as a balanced tree: depth log2(n), so hundreds of
    rules do not overflow the JVM stack while the plan is analysed."""
    cols = list(cols)
    while len(cols) > 1:
        cols = [cols[i] & cols[i + 1] if i + 1 < len(cols) else cols[i] for i in range(0, len(cols), 2)]
    return cols[0]


def beside(column: Column) -> Column:
    """Always TRUE.  An operator that holds a lambda is left out of whole-stage codegen, where all
    rules would be one method, and beyond 8,000 bytes of bytecode the JVM only interprets a method.
    Outside, Spark compiles the operator's expressions into small methods.  Only what lies under
    the lambda is interpreted, so it stands beside the rules and reads one ``column``."""
    return F.forall(F.array(column), lambda _: F.lit(True))


def split_filter(rules: Sequence["CompiledRule"]) -> Column:
    """TRUE when every rule holds: a plain conjunction, cheap rules first, so that they reach the
    scan and spare a failing row the expensive ones."""
    ordered = cheap_first(rules)
    conj = all_of([r.predicate if _RULE_COST.get(r.rule, _DEFAULT_COST) <= _PUSHABLE_COST else r.passed for r in ordered])
    return conj & beside(ordered[0].column) if len(rules) > FEW_RULES else conj


# ---------------------------------------------------------------------------
# Compilation
# ---------------------------------------------------------------------------

@dataclass
class CompiledRule:
    index: int
    field: str
    rule: str
    label: str
    predicate: Column
    column: Column

    @cached_property
    def passed(self) -> Column:
        """TRUE only when the rule holds; NULL counts as a failure (D-1)."""
        return F.coalesce(self.predicate, F.lit(False))

    @cached_property
    def failed(self) -> Column:
        return ~self.passed


@dataclass
class CompiledRules:
    frame: DataFrame                 # input plus helper columns of table-level rules
    rules: list[CompiledRule]        # grouped by field (first appearance), config order within
    fields: list[str]
    helper_cols: list[str] = dc_field(default_factory=list)
    source: DataFrame | None = None  # the input
    unique: list[tuple[Column, str]] = dc_field(default_factory=list)  # (key, flag) of each table-level rule
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT
    flagged: bool = False            # the input brings the flags of its table-level rules

    def row_rules(self) -> list["CompiledRule"]:
        return [r for r in self.rules if r.rule != "unique"]

    def after_row_rules(self) -> DataFrame:
        """``frame`` without the rows that fail a row rule: these are dropped at the
        scan, before any key is joined; keys are counted over the whole input."""
        rules = self.row_rules()
        if not self.unique or not rules or self.flagged:
            return self.frame
        out = self.source.filter(split_filter(rules))
        for key, flag in self.unique:
            out = flag_duplicates(out, key, flag, counted=self.source, rows_per_salt=self.rows_per_salt)
        return out

    def by_field(self) -> list[tuple[str, list[CompiledRule]]]:
        return [(f, [r for r in self.rules if r.field == f]) for f in self.fields]


def compile_rules(
    df: DataFrame,
    rules: Any,
    *,
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
    flags: Sequence[str] | None = None,
) -> CompiledRules:
    """Check every block eagerly (D-12) and compile it to predicates.

    A field named by several blocks keeps all their rules, in order (D3).
    ``flags`` names a column of ``df`` for each ``unique`` rule that says whether the
    row's key is duplicated; without it the keys are counted over ``df``.
    """
    if not isinstance(rules, list):
        raise TypeError("rules are a list of rule blocks")
    frame = df
    helpers: list[str] = []
    unique: list[tuple[Column, str]] = []
    per_field: dict[str, list[tuple[str, str, Column, Column]]] = {}
    for block in rules:
        if not isinstance(block, Mapping):
            raise InvalidValidationConfig(f"a rule block is a dict, not {block!r}")
        fname = block.get("field")
        column, dtype, ref = resolve_field(df, fname)
        entries = block.get("validations")
        if not isinstance(entries, list) or not entries:
            raise InvalidValidationConfig(f"rule block for {fname!r} lists no validations")
        block_msg = block.get("message")
        if block_msg is not None and not isinstance(block_msg, str):
            raise InvalidValidationConfig(f"rule block for {fname!r}: 'message' must be text")
        for raw in entries:
            try:
                entry = parse_entry(raw)
                if not entry.enabled:  # E4
                    continue
                if entry.type == "unique":  # E1: needs the whole table
                    key = unique_key(df, column, entry.params)
                    if flags is not None:
                        flag = flags[len(helpers)]
                    elif df.isStreaming:
                        raise InvalidValidationConfig("'unique' on a stream needs an event-time horizon; use validate_stream()")
                    else:
                        flag = f"__dq_dup_{len(helpers)}"
                        frame = flag_duplicates(frame, key, flag, counted=df, rows_per_salt=rows_per_salt)
                    helpers.append(flag)
                    unique.append((key, flag))
                    pred = key.isNotNull() & ~F.col(flag)
                else:
                    pred = build_predicate(entry, column, dtype, ref)
            except ValidationException as exc:
                raise InvalidValidationConfig(f"rule for {fname!r}: {exc}") from exc
            label = entry.message or block_msg or f"{fname}:{entry.type}"  # D-6
            per_field.setdefault(fname, []).append((entry.type, label, pred, column))
    compiled = []
    for fname, items in per_field.items():
        for rule, label, pred, column in items:
            compiled.append(CompiledRule(len(compiled), fname, rule, label, pred, column))
    return CompiledRules(frame, compiled, list(per_field), helpers, df, unique, rows_per_salt, flags is not None)


def unique_key(df: DataFrame, column: Column, params: Mapping[str, Any]) -> Column:
    """The key of a ``unique`` rule: its field, or a struct of all ``fields``; NULL if any part is NULL."""
    names = params.get("fields")
    if names is None:
        return column
    if not isinstance(names, (list, tuple)) or not names:
        raise InvalidValidationConfig("'fields' of a unique rule is a list of column names")
    found = [resolve_field(df, n) for n in names]
    # -0.0 and 0.0 are one value, as they are in a key that is not part of a struct.
    parts = [c + F.lit(0.0) if isinstance(t, (T.FloatType, T.DoubleType)) else c for c, t, _ in found]
    whole = F.struct(*[p.alias(f"_{i}") for i, p in enumerate(parts)])
    return F.when(all_of([c.isNotNull() for c, _, _ in found]), whole)


def rule_predicate(df: DataFrame, field: str, entry: Any) -> Column:
    """One row rule as a plain predicate on ``df[field]`` (NULL counts as failed
    only once wrapped by ``validate``).  For building custom filters."""
    column, dtype, ref = resolve_field(df, field)
    parsed = parse_entry(entry)
    if parsed.type == "unique":
        raise InvalidValidationConfig("'unique' needs the whole table; use validate()")
    return build_predicate(parsed, column, dtype, ref)


# ---------------------------------------------------------------------------
# Result
# ---------------------------------------------------------------------------

@dataclass
class ValidationResult:
    ok: DataFrame
    ko: DataFrame
    compiled: CompiledRules | None
    materialized: DataFrame | None = None
    clean: Column | None = None  # "no rule failed" over the materialized frame
    observation: Observation | None = None  # metrics collected by the KO branch's own scan
    _all: Any = dc_field(default=None, repr=False)  # builds the annotated table on demand
    observation_all: Observation | None = None  # same metrics, collected by the annotated table's scan

    def __iter__(self):  # allows ``ok, ko = validate(...)``
        return iter((self.ok, self.ko))

    def release(self) -> None:
        """Drop the persisted annotated frame (``materialize="persist"``)."""
        if self.materialized is not None:
            self.materialized.unpersist()

    def stats(self) -> DataFrame:
        """D-13 in one pass: total / valid / invalid counts and percentages."""
        c = self.compiled
        if c is None or not c.rules:
            base = self.ok.agg(F.count(F.lit(1)).alias("total_records"))
            counts = base.withColumn("valid_records", F.col("total_records"))
        elif self.materialized is not None:  # read the kept annotations, no re-evaluation
            counts = self.materialized.agg(
                F.count(F.lit(1)).alias("total_records"),
                F.count_if(self.clean).alias("valid_records"),
            )
        else:
            passed = all_of([r.passed for r in cheap_first(c.rules)])
            counts = c.frame.agg(
                F.count(F.lit(1)).alias("total_records"),
                F.count_if(passed).alias("valid_records"),
            )
        total, valid = F.col("total_records"), F.col("valid_records")
        return counts.select(
            total,
            valid,
            (total - valid).alias("invalid_records"),
            F.when(total > 0, valid * 100.0 / total).otherwise(F.lit(0.0)).alias("valid_percentage"),
            F.when(total > 0, (total - valid) * 100.0 / total).otherwise(F.lit(0.0)).alias("invalid_percentage"),
        )

    def annotated(self) -> DataFrame:
        """Every input row with ``is_valid`` and the error columns (NULL for valid rows).

        One pass serves both outputs: write it with ``partitionBy("is_valid")``
        to get accepted and rejected rows from a single scan and a single job,
        with no persisted copy.
        """
        if self._all is None:
            raise InvalidValidationConfig("no rules, nothing to annotate")
        return self._all()

    def _observed(self, source: str) -> dict | None:
        obs = self.observation_all if source == "all" else self.observation
        if obs is None:
            raise InvalidValidationConfig("validate(..., observe=True) was not used")
        try:
            found = obs.get  # blocks until that frame has run once
        except Py4JJavaError as exc:
            if "assertion failed" not in str(exc):
                raise
            return None  # the metrics' place was optimised away: nothing was counted
        return found if "total_records" in found else None

    def observed_stats(self, spark, source: str = "ko") -> DataFrame:
        """``stats()`` from the metrics collected while the KO branch (``source="ko"``)
        or the annotated table (``"all"``) ran: no extra scan.  Call only after
        that frame was written or collected."""
        m = self._observed(source)
        if m is None:  # the optimiser removed the scan: count directly
            return self.stats().coalesce(1)
        total, valid = int(m["total_records"]), int(m["valid_records"])
        pct = (lambda x: x * 100.0 / total) if total else (lambda x: 0.0)
        return spark.createDataFrame(
            [(total, valid, total - valid, pct(valid), pct(total - valid))],
            "total_records long, valid_records long, invalid_records long, "
            "valid_percentage double, invalid_percentage double",
        ).coalesce(1)

    def observed_failures(self, spark, source: str = "ko") -> DataFrame:
        """``failures_by_rule()`` from collected metrics (see ``observed_stats``)."""
        m = self._observed(source)
        if m is None:
            return self.failures_by_rule().coalesce(1)
        rows = [(r.index, r.field, r.rule, r.label, int(m[f"__dq_f{r.index}"])) for r in self.compiled.rules]
        # one row per rule: a bounded table, kept in one partition (one output file)
        return spark.createDataFrame(
            rows, "rule_index int, field string, rule string, message string, failures long").coalesce(1)

    def failures_by_rule(self) -> DataFrame:
        """Failing rows per rule, as one global aggregation (no explode,
        no per-row shuffle: partial counts per task, one tiny final merge)."""
        c = self.compiled
        if c is None or not c.rules:
            raise InvalidValidationConfig("failures_by_rule needs at least one rule")
        agg = c.frame.agg(*[F.count_if(r.failed).alias(f"__dq_f{r.index}") for r in c.rules])
        entries = F.array(*[
            F.struct(
                F.lit(r.index).alias("rule_index"),
                F.lit(r.field).alias("field"),
                F.lit(r.rule).alias("rule"),
                F.lit(r.label).alias("message"),
                F.col(f"__dq_f{r.index}").alias("failures"),
            )
            for r in c.rules
        ])
        return agg.select(F.inline(entries))


def _empty_ko(df: DataFrame) -> DataFrame:
    return df.limit(0).select(
        "*",
        F.lit(None).cast("map<string,array<string>>").alias(ERRORS_MAP),
        F.lit(None).cast("string").alias(ERRORS_TEXT),
    )


@dataclass
class Part:
    """Rules that are reported by one look-up: a bit of the column ``mask`` for each rule that failed."""

    mask: str
    rules: list[CompiledRule]
    whole: bool  # all rules of its fields are here


def _parts(c: CompiledRules) -> list[Part]:
    """The rules in their order, whole fields together, at most ``PART_RULES`` a part; a field with more is cut."""
    groups: list[tuple[list[CompiledRule], bool]] = []
    for _, rules in c.by_field():
        if len(rules) > PART_RULES:
            groups += [(rules[i:i + PART_RULES], False) for i in range(0, len(rules), PART_RULES)]
        elif groups and groups[-1][1] and len(groups[-1][0]) + len(rules) <= PART_RULES:
            groups[-1] = (groups[-1][0] + rules, True)
        else:
            groups.append((rules, True))
    return [Part(f"{MASK}{i}", rules, whole) for i, (rules, whole) in enumerate(groups)]


def _masks(c: CompiledRules, parts: list[Part]) -> list[Column]:
    """A number for each part: which of its rules a row fails.  This is where the rules of a report are
    evaluated, all of them compiled and in one projection (several columns read each mask, so Spark
    does not merge it with the next)."""
    out = []
    for k, part in enumerate(parts):
        mask = None
        for i, rule in enumerate(part.rules):
            failed = beside(rule.column) & rule.failed if len(c.rules) > FEW_RULES and not k and not i else rule.failed
            bit = F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
            mask = bit if mask is None else mask.bitwiseOR(bit)
        out.append(mask.alias(part.mask))
    return out


def _none_failed(parts: list[Part]) -> Column:
    return all_of([F.col(p.mask) == 0 for p in parts])


def _answers(part: Part, max_per_field: int) -> Column:
    """What a part reports, for the row's mask: the map ``m``, the labels ``a`` and their text ``t``.

    A constant table with an entry for each mask, so a report is looked up, not assembled."""
    table = []
    for mask in range(1 << len(part.rules)):
        failed = [r for i, r in enumerate(part.rules) if mask >> i & 1]
        by_field: dict[str, list[str]] = {}
        for r in failed:
            by_field.setdefault(r.field, []).append(r.label)
        labels = [r.label for r in failed]
        limited = {f: v[:max_per_field] if max_per_field > 0 and part.whole else v for f, v in by_field.items()}
        table.append({"m": limited, "a": labels, "t": JOINER.join(labels) if failed else None})
    # Spark evaluates a constant expression once, when it optimises the plan.
    constant = F.from_json(F.lit(json.dumps(table)), "array<struct<m: map<string,array<string>>, a: array<string>, t: string>>")
    return F.get(constant, F.col(part.mask))


def _error_map(parts: list[Part], answers: list[Column], max_per_field: int) -> Column:
    """D-8: field -> labels of its failed rules (D-7)."""
    maps: list[Column] = []
    cut: dict[str, list[tuple[Part, Column]]] = {}
    for part, answer in zip(parts, answers):
        if part.whole:
            maps.append(answer["m"])
        else:
            cut.setdefault(part.rules[0].field, []).append((part, answer))
    for fname, pieces in cut.items():
        labels = F.concat(*[answer["a"] for _, answer in pieces])
        kept = F.slice(labels, 1, max_per_field) if max_per_field > 0 else labels
        none = F.from_json(F.lit("{}"), "map<string,array<string>>")
        maps.append(F.when(_none_failed([p for p, _ in pieces]), none).otherwise(F.create_map(F.lit(fname), kept)))
    return F.map_concat(*maps) if len(maps) > 1 else maps[0]


def _report(
    annotated: DataFrame,
    out_cols: list[str],
    parts: list[Part],
    max_per_field: int,
    max_per_row: int,
    keep_array: bool,
    only_when: Column | None = None,
) -> DataFrame:
    """Derive the error map / text / array from the masks of failed rules.

    A limit that a row cannot reach with its number of rules is left out of the
    plan.  With ``only_when`` the report is built only for rows where it holds
    (NULL elsewhere); CASE WHEN evaluates its branch lazily, so other rows skip it.
    """
    def gated(col: Column) -> Column:
        return col if only_when is None else F.when(only_when, col)

    answers = [_answers(p, max_per_field) for p in parts]
    labels = F.concat(*[a["a"] for a in answers]) if len(answers) > 1 else answers[0]["a"]
    text = F.concat_ws(JOINER, *[a["t"] for a in answers])  # skips NULLs
    if 0 < max_per_row < sum(len(p.rules) for p in parts):  # D-9
        n = F.size(labels)
        short = F.concat(F.concat_ws(JOINER, F.slice(labels, 1, max_per_row)), F.lit(MORE_PREFIX), (n - max_per_row).cast("string"), F.lit(MORE_SUFFIX))
        text = F.when(n > max_per_row, short).otherwise(text)
    unknown = _none_failed(parts)
    if len(parts) > FEW_PARTS:
        unknown = unknown & beside(F.col(parts[0].mask))
    text = F.when(unknown, F.lit(UNKNOWN_ERROR)).otherwise(text)
    final = [F.col(quote(n)) for n in out_cols]
    final += [gated(_error_map(parts, answers, max_per_field)).alias(ERRORS_MAP), gated(text).alias(ERRORS_TEXT)]
    if keep_array:  # D-10: untruncated
        final.append(gated(labels).alias(ERRORS_ARRAY))
    return annotated.select(*final)


def _deterministic(df: DataFrame, c: CompiledRules) -> bool:
    """Whether reading ``df`` and its row rules twice gives the same rows and verdicts."""
    rules = c.row_rules()
    probe = df.select(*[r.passed.alias(f"__dq_{r.index}") for r in rules]) if rules else df
    jdf = getattr(probe, "_jdf", None)  # a Spark Connect frame has no plan to ask
    return jdf is None or bool(jdf.queryExecution().analyzed().deterministic())


def _materialize(df: DataFrame, how: str) -> DataFrame:
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        from dqflow.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"materialize must be 'none', 'persist' or 'checkpoint', got {how!r}")


def validate(
    df: DataFrame,
    rules: Any,
    *,
    max_errors_per_field: int = DEFAULT_MAX_ERRORS,
    max_errors_per_row: int = DEFAULT_MAX_ERRORS,
    keep_array: bool = False,
    materialize: str = "none",
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
    observe: bool = False,
    flags: Sequence[str] | None = None,
) -> ValidationResult:
    """Split ``df`` into ``(ok, ko)`` by ``rules``; see the module docstring.

    ``observe=True`` makes the KO branch count, while it scans, the total and
    valid rows and the failures of every rule (an ``Observation`` placed above
    the scan, below the KO filter; the OK branch keeps its pushdown).  After
    the KO frame has run once, ``observed_stats`` / ``observed_failures``
    return those numbers without another pass over the data.

    ``ok`` keeps the input columns unchanged (D-4).  ``ko`` adds
    ``validation_errors`` (map field -> labels, at most
    ``max_errors_per_field`` each), ``validation_errors_text`` (labels joined
    by ``"; "``, at most ``max_errors_per_row`` then ``"; ... (+K more)"``)
    and, with ``keep_array``, the untruncated ``validation_errors_array``.
    A limit <= 0 means no limit, which is the default.

    ``rows_per_salt`` tunes the ``unique`` rule's skew handling: a key with more
    rows is split over ``ceil(count / rows_per_salt)`` join tasks.  ``flags`` names
    columns of ``df`` that already hold the verdicts of the ``unique`` rules, in order; they are
    left out of the results.
    """
    if not isinstance(rules, list):
        raise TypeError("rules are a list of rule blocks")
    if not rules:  # D-11
        return ValidationResult(df, _empty_ko(df), None)
    for name in _ERROR_COLS:
        if name in df.columns:
            raise InvalidValidationConfig(f"input already has a column named '{name}'")
    c = compile_rules(df, rules, rows_per_salt=rows_per_salt, flags=flags)
    if not c.rules:  # every rule disabled
        return ValidationResult(df, _empty_ko(df), c)

    out_cols = [n for n in df.columns if n not in (flags or ())]
    parts = _parts(c)
    masks = _masks(c, parts)
    none_failed = _none_failed(parts)

    def metrics() -> list[Column]:
        return [
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(all_of([r.passed for r in cheap_first(c.rules)])).alias("valid_records"),
            *[F.count_if(r.failed).alias(f"__dq_f{r.index}") for r in c.rules],
        ]

    observation = None
    observed_frame = c.frame
    if observe:
        observation = Observation(f"dqflow_validate_{uuid.uuid4().hex}")
        observed_frame = c.frame.observe(observation, *metrics())

    if not df.isStreaming and not _deterministic(df, c):
        materialize = "checkpoint"
    annotated_all = clean = None
    if materialize == "none":
        conj = split_filter(c.rules)
        ok = c.after_row_rules().filter(conj)
        ko_rows = observed_frame.filter(~F.coalesce(conj, F.lit(False)))
        annotated = ko_rows.select("*", *masks)
    else:
        annotated_all = _materialize(observed_frame.select("*", *masks), materialize)
        clean = none_failed
        ok = annotated_all.filter(clean)
        annotated = annotated_all.filter(~clean)

    if c.helper_cols or materialize != "none":
        ok = ok.select(*[F.col(quote(n)) for n in out_cols])
    limits = (max_errors_per_field, max_errors_per_row, keep_array)
    ko = _report(annotated, out_cols, parts, *limits)

    def annotate_all() -> DataFrame:
        if VALID_FLAG in out_cols:
            raise InvalidValidationConfig(f"input already has a column named '{VALID_FLAG}'")
        source = c.frame
        if observe and annotated_all is None:
            result.observation_all = Observation(f"dqflow_validate_all_{uuid.uuid4().hex}")
            source = c.frame.observe(result.observation_all, *metrics())
        every = annotated_all if annotated_all is not None else source.select("*", *masks)
        every = every.withColumn(VALID_FLAG, none_failed)
        return _report(every, out_cols + [VALID_FLAG], parts, *limits, only_when=~F.col(VALID_FLAG))

    result = ValidationResult(ok, ko, c, annotated_all, clean, observation, annotate_all)
    return result


def apply_validations(df: DataFrame, rules: Any, **options: Any) -> tuple[DataFrame, DataFrame]:
    """Library entry (D-14): ``(valid_df, invalid_df)``."""
    res = validate(df, rules, **options)
    return res.ok, res.ko
