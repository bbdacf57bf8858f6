"""Table steps (T1-T7) and the user-extensible step registry.

Every step is a plain function ``(df, params, ctx) -> DataFrame`` (the
validate step returns a ``ValidationResult``).  Parameters are checked
eagerly (T8) before any DataFrame is built.  SQL strings go to Spark's own
expression parser, so the full Spark SQL scalar, window and generator
surface is available in ``filter_rows`` / ``derive_column``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.errors import ExecutionError, TransformationError, ValidationError
from dqflow.operators.validation import quote, validate


@dataclass
class StepContext:
    """Values fixed once per run, shared by every step."""

    run_id: str = ""
    run_timestamp: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


StepFn = Callable[[DataFrame, Mapping[str, Any], StepContext], Any]

TRANSFORMS: dict[str, StepFn] = {}


def register_transform(name: str, fn: StepFn | None = None):
    """Register a step type; usable as ``register_transform("x", fn)`` or as a decorator."""
    if not name or not isinstance(name, str):
        raise ValueError("transform name must be a non-empty string")

    def deco(f: StepFn) -> StepFn:
        TRANSFORMS[name] = f
        return f

    return deco(fn) if fn is not None else deco


def list_transforms() -> list[str]:
    return sorted(TRANSFORMS)


def _require(step: str, params: Mapping[str, Any], *names: str) -> None:
    missing = [n for n in names if not params.get(n)]
    if missing:
        raise ValidationError(f"{step}: parameters {missing} are required")


def _list_param(step: str, params: Mapping[str, Any], name: str) -> list:
    _require(step, params, name)
    value = params[name]
    if not isinstance(value, list):
        raise ValidationError(f"{step}: '{name}' must be a list, got {type(value).__name__}")
    return value


@register_transform("filter_rows")
def filter_rows(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """Keep rows where the SQL condition is true (NULL drops the row)."""
    _require("filter_rows", params, "condition")
    return df.filter(F.expr(params["condition"]))


@register_transform("derive_column")
def derive_column(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """``expression AS column``; an existing column of that name is replaced."""
    _require("derive_column", params, "column", "expression")
    name, expr = params["column"], F.expr(params["expression"])
    if any(c.lower() == name.lower() for c in df.columns):
        return df.withColumn(name, expr)
    return df.select("*", expr.alias(name))


@register_transform("select_columns")
def select_columns(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """Projection in the given order (``*`` and ``s.f`` paths allowed)."""
    return df.select(*_list_param("select_columns", params, "columns"))


@register_transform("rename_columns")
def rename_columns(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """T4: renames applied in order (``a->b, b->c`` gives ``c``); unknown names are ignored."""
    _require("rename_columns", params, "mappings")
    mappings = params["mappings"]
    if not isinstance(mappings, Mapping):
        raise ValidationError(f"rename_columns: 'mappings' must be a dict, got {type(mappings).__name__}")
    return df.withColumnsRenamed(dict(mappings))


@register_transform("drop_columns")
def drop_columns(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """T5: drop columns; unknown names are ignored."""
    return df.drop(*_list_param("drop_columns", params, "columns"))


# Functions available to add_fields (T6).  The run timestamp is one literal
# per run (D9), so every sink of a run carries the same value.
FIELD_FUNCTIONS: dict[str, Callable[[StepContext], Any]] = {
    "current_timestamp": lambda ctx: F.lit(ctx.run_timestamp).cast("timestamp"),
}


@register_transform("add_fields")
def add_fields(df: DataFrame, params: Mapping[str, Any], ctx: StepContext) -> DataFrame:
    """Add computed fields ``[{name, function}]`` in one projection."""
    fields = _list_param("add_fields", params, "addFields")
    cols = {}
    for spec in fields:
        if not isinstance(spec, Mapping):
            raise ValidationError(f"add_fields: field definition must be a dict, got {spec!r}")
        name, fn = spec.get("name"), spec.get("function")
        if not name:
            raise ValidationError("add_fields: every field needs a 'name'")
        if not fn:
            raise ValidationError("add_fields: every field needs a 'function'")
        if fn not in FIELD_FUNCTIONS:
            raise ValidationError(f"add_fields: function {fn!r} (field {name!r}) is not one of {sorted(FIELD_FUNCTIONS)}")
        cols[name] = FIELD_FUNCTIONS[fn](ctx)
    return df.withColumns(cols)


VALIDATE_OPTIONS = (
    "max_errors_per_field", "max_errors_per_row", "keep_array", "materialize", "rows_per_salt", "observe",
)


@register_transform("validate_fields")
def validate_fields(df: DataFrame, params: Mapping[str, Any], ctx: StepContext):
    """Returns a ``ValidationResult`` (``ok``, ``ko``, stats, failures)."""
    rules = _list_param("validate_fields", params, "validations")
    options = {k: params[k] for k in VALIDATE_OPTIONS if k in params}
    return validate(df, rules, **options)


def apply_transform(step_type: str, df: DataFrame, params: Mapping[str, Any], ctx: StepContext | None = None):
    """Run one step; unknown types list what is available."""
    fn = TRANSFORMS.get(step_type)
    if fn is None:
        raise ValueError(f"no step type {step_type!r}; known types: {', '.join(list_transforms())}")
    try:
        return fn(df, params, ctx or StepContext())
    except TransformationError:
        raise
    except Exception as exc:
        if exc.__class__.__module__.startswith("dqflow"):
            raise
        raise ExecutionError(f"{step_type} failed: {exc}") from exc


__all__ = [
    "StepContext",
    "TRANSFORMS",
    "apply_transform",
    "list_transforms",
    "register_transform",
    "quote",
]
