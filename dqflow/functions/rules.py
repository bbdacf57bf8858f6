"""Row rules (V1-V27): each rule compiles to a native boolean ``Column``.

A rule builder receives the resolved column, its Spark ``DataType`` and the
rule's parameters and returns a predicate.  The predicate may evaluate to
NULL; the validator treats NULL as *fail*.  Builders never produce an
expression that can throw on bad data (even with ANSI mode on): numbers are
read with ``try_cast`` and comparisons are typed by the column's schema
type, so Catalyst still sees plain column-vs-literal comparisons (and pushes
them to the scan) whenever the column is already of the compared type.

No rule uses a Python UDF.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any, Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqflow.errors import InvalidValidationConfig, ValidatorNotFoundError

# ---------------------------------------------------------------------------
# Fixed values.  These patterns define what the format rules accept and must
# stay exactly as written (Java regular expressions, search semantics of
# RLIKE; the anchors are part of the patterns).
# ---------------------------------------------------------------------------
INTEGER_PATTERN = r"^-?\d+$"
EMAIL_PATTERN = r"^[a-zA-Z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[a-zA-Z0-9!#$%&'*+/=?^_`{|}~-]+)*@(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?\.)*[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?$"  # noqa: E501
PHONE_PATTERN = r"^\+?[1-9]\d{1,14}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DATETIME_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
URL_PATTERN = r"^https?://[^\s/$.?#].[^\s]*$"

# Fixed value: keys of a rule dict that are metadata, not builder parameters.
METADATA_KEYS = frozenset({"type", "message", "enabled", "description"})

# Rules that need the whole table (an aggregation), not just the row.
AGGREGATE_RULES = frozenset({"unique"})


# ---------------------------------------------------------------------------
# Type-aware views of a column
# ---------------------------------------------------------------------------

def _is_text(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.CharType, T.VarcharType))


def as_text(c: Column, dt: T.DataType) -> Column:
    """The column as a string (Spark's own text rendering for non-strings)."""
    return c if _is_text(dt) else c.cast("string")


def as_double(c: Column, dt: T.DataType) -> Column:
    """The column as a number; NULL where the value is not a number.

    Numeric columns are returned untouched so that comparisons with a
    literal stay pushable to the scan.
    """
    if isinstance(dt, T.NumericType):
        return c
    if isinstance(dt, (T.BooleanType, T.TimestampType)):
        return c.try_cast("double")
    return as_text(c, dt).try_cast("double")


def _text_length(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.BinaryType):
        return F.length(c)
    return F.length(as_text(c, dt))


def _is_number(v: Any) -> bool:
    return isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)


def _comparable(c: Column, dt: T.DataType, v: Any) -> tuple[str, Column, Column]:
    """Return ``(kind, lhs, rhs)`` such that ``lhs == rhs`` means "equals v".

    Same-type comparisons use the bare column (pushable); mixed types are
    compared as numbers or as text, never with a cast that can throw.
    """
    if isinstance(v, bool):
        if isinstance(dt, T.BooleanType):
            return "direct", c, F.lit(v)
        if isinstance(dt, T.NumericType):  # a 0/1 flag column
            return "direct", c, F.lit(1 if v else 0)
        return "text", as_text(c, dt), F.lit("true" if v else "false")
    if _is_number(v):
        if isinstance(dt, T.NumericType):
            return "direct", c, F.lit(v)
        return "number", as_double(c, dt), F.lit(float(v))
    if isinstance(v, str):
        if _is_text(dt):
            return "direct", c, F.lit(v)
        if isinstance(dt, T.BooleanType):  # "true" / "false" (and Spark's other boolean spellings)
            return "direct", c, F.lit(v).try_cast("boolean")
        if isinstance(dt, T.NumericType):
            return "number", as_double(c, dt), F.lit(v).try_cast("double")
        if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "direct", c, F.lit(v).try_cast(dt)
        return "text", as_text(c, dt), F.lit(v)
    raise InvalidValidationConfig(f"unsupported comparison value {v!r} ({type(v).__name__})")


# ---------------------------------------------------------------------------
# Parameter helpers (D10: only an absent parameter is missing)
# ---------------------------------------------------------------------------

def _first_present(p: Mapping[str, Any], *names: str) -> Any:
    for n in names:
        if p.get(n) is not None:
            return p[n]
    return None


def _need(rule: str, value: Any, names: str) -> Any:
    if value is None:
        raise InvalidValidationConfig(f"{rule} requires {names}")
    return value


def _count(rule: str, value: Any, names: str) -> int:
    """A non-negative whole number; ``2``, ``2.0`` and ``"2"`` are all accepted."""
    value = _need(rule, value, names)
    n = None
    if isinstance(value, int) and not isinstance(value, bool):
        n = value
    elif isinstance(value, float) and value.is_integer():
        n = int(value)
    elif isinstance(value, str) and value.strip().isdigit():
        n = int(value.strip())
    if n is None or n < 0:
        raise InvalidValidationConfig(f"{rule}: {names} must be a non-negative integer, got {value!r}")
    return n


def _number(rule: str, value: Any, names: str) -> float | int:
    value = _need(rule, value, names)
    if _is_number(value):
        return value
    if isinstance(value, str):
        try:
            return float(value)
        except ValueError:
            pass
    raise InvalidValidationConfig(f"{rule}: {names} must be a number, got {value!r}")


def _text(rule: str, value: Any, names: str, allow_empty: bool = True) -> str:
    value = _need(rule, value, names)
    if not isinstance(value, str) or (not allow_empty and value == ""):
        raise InvalidValidationConfig(f"{rule}: {names} must be a {'non-empty ' if not allow_empty else ''}string")
    return value


# ---------------------------------------------------------------------------
# Builders
# ---------------------------------------------------------------------------

Builder = Callable[[Column, T.DataType, Mapping[str, Any], str], Column]


def _not_null(c, dt, p, ref):
    return c.isNotNull()


def _not_empty(c, dt, p, ref):
    if _is_text(dt):
        return c != F.lit("")
    if isinstance(dt, (T.ArrayType, T.MapType)):
        return F.size(c) > 0
    if isinstance(dt, T.BinaryType):
        return F.length(c) > 0
    return c.isNotNull()


def _numeric(c, dt, p, ref):
    return as_double(c, dt).isNotNull()


def _integer(c, dt, p, ref):
    if isinstance(dt, T.IntegralType):
        return c.isNotNull()
    return as_text(c, dt).rlike(INTEGER_PATTERN)


def _positive(c, dt, p, ref):
    return as_double(c, dt) > F.lit(0)


def _non_negative(c, dt, p, ref):
    return as_double(c, dt) >= F.lit(0)


def _regex(pattern: str) -> Builder:
    def build(c, dt, p, ref):
        return as_text(c, dt).rlike(pattern)
    return build


def _min_length(c, dt, p, ref):
    n = _count("minLength", _first_present(p, "min_len", "value"), "'value' or 'min_len'")
    return _text_length(c, dt) >= F.lit(n)


def _max_length(c, dt, p, ref):
    n = _count("maxLength", _first_present(p, "max_len", "value"), "'value' or 'max_len'")
    return _text_length(c, dt) <= F.lit(n)


def _length_between(c, dt, p, ref):
    lo = _count("lengthBetween", p.get("min_len"), "'min_len'")
    hi = _count("lengthBetween", p.get("max_len"), "'max_len'")
    return _text_length(c, dt).between(F.lit(lo), F.lit(hi))


def _between(c, dt, p, ref):
    lo = _number("between", _first_present(p, "min", "min_val"), "'min' (or 'min_val')")
    hi = _number("between", _first_present(p, "max", "max_val"), "'max' (or 'max_val')")
    v = as_double(c, dt)
    return (v >= F.lit(lo)) & (v <= F.lit(hi))


def _greater_than(c, dt, p, ref):
    return as_double(c, dt) > F.lit(_number("greaterThan", p.get("value"), "'value'"))


def _less_than(c, dt, p, ref):
    return as_double(c, dt) < F.lit(_number("lessThan", p.get("value"), "'value'"))


def _equals(c, dt, p, ref):
    if "value" not in p or p["value"] is None:
        raise InvalidValidationConfig("equals requires a non-null 'value'")
    _, lhs, rhs = _comparable(c, dt, p["value"])
    return lhs == rhs


def _pattern(c, dt, p, ref):
    rx = _text("pattern", _first_present(p, "regex", "regex_pattern"), "'regex' or 'regex_pattern'", allow_empty=False)
    return as_text(c, dt).rlike(rx)


def _in_list(c, dt, p, ref):
    values = _first_present(p, "values", "allowed_values")
    if not isinstance(values, (list, tuple)) or not values:
        raise InvalidValidationConfig("inList requires a non-empty list in 'values' or 'allowed_values'")
    groups: dict[str, tuple[Column, list[Column]]] = {}
    for v in values:
        if v is None:
            continue
        kind, lhs, rhs = _comparable(c, dt, v)
        groups.setdefault(kind, (lhs, []))[1].append(rhs)
    if not groups:
        raise InvalidValidationConfig("inList: every value is null")
    # One IN per comparison kind keeps the common case a single pushable In.
    return reduce(lambda a, b: a | b, [lhs.isin(*rhs) for lhs, rhs in groups.values()])


def _starts_with(c, dt, p, ref):
    return as_text(c, dt).startswith(_text("startsWith", p.get("prefix"), "'prefix'"))


def _ends_with(c, dt, p, ref):
    return as_text(c, dt).endswith(_text("endsWith", p.get("suffix"), "'suffix'"))


def _contains(c, dt, p, ref):
    return as_text(c, dt).contains(_text("contains", p.get("substring"), "'substring'"))


def _custom_sql(c, dt, p, ref):
    expr = _text("custom_sql", p.get("expression"), "'expression'", allow_empty=False)
    return F.expr(expr.replace("{column}", ref))


@dataclass(frozen=True)
class RuleDef:
    name: str
    build: Builder | None
    params: tuple[str, ...] = ()

    @property
    def parameterised(self) -> bool:
        return bool(self.params)


def _defs(*defs: RuleDef) -> dict[str, RuleDef]:
    return {d.name: d for d in defs}


RULES: dict[str, RuleDef] = _defs(
    # No parameters
    RuleDef("notNull", _not_null),
    RuleDef("notEmpty", _not_empty),
    RuleDef("numeric", _numeric),
    RuleDef("integer", _integer),
    RuleDef("positive", _positive),
    RuleDef("nonNegative", _non_negative),
    RuleDef("email", _regex(EMAIL_PATTERN)),
    RuleDef("phone", _regex(PHONE_PATTERN)),
    RuleDef("dateFormat", _regex(DATE_PATTERN)),
    RuleDef("datetimeFormat", _regex(DATETIME_PATTERN)),
    RuleDef("uuid", _regex(UUID_PATTERN)),
    RuleDef("url", _regex(URL_PATTERN)),
    # parameterised
    RuleDef("minLength", _min_length, ("value", "min_len")),
    RuleDef("maxLength", _max_length, ("value", "max_len")),
    RuleDef("lengthBetween", _length_between, ("min_len", "max_len")),
    RuleDef("between", _between, ("min", "max", "min_val", "max_val")),
    RuleDef("greaterThan", _greater_than, ("value",)),
    RuleDef("lessThan", _less_than, ("value",)),
    RuleDef("equals", _equals, ("value",)),
    RuleDef("pattern", _pattern, ("regex", "regex_pattern")),
    RuleDef("inList", _in_list, ("values", "allowed_values")),
    RuleDef("startsWith", _starts_with, ("prefix",)),
    RuleDef("endsWith", _ends_with, ("suffix",)),
    RuleDef("contains", _contains, ("substring",)),
    # V25 and its documented alias
    RuleDef("custom_sql", _custom_sql, ("expression",)),
    RuleDef("custom_expr", _custom_sql, ("expression",)),
    # Table-level; compiled by the validator (needs an aggregation)
    RuleDef("unique", None),
)


def rule_names() -> list[str]:
    """Sorted names of every registered rule."""
    return sorted(RULES)


def param_hints(name: str) -> list[str]:
    d = RULES.get(name)
    return list(d.params) if d and d.params else []


def register_rule(name: str, build: Builder, params: tuple[str, ...] = ()) -> None:
    """Add a rule.  ``build(column, dtype, params, sql_ref) -> Column``."""
    if not name or not isinstance(name, str):
        raise InvalidValidationConfig("rule name must be a non-empty string")
    RULES[name] = RuleDef(name, build, tuple(params))


@dataclass(frozen=True)
class RuleEntry:
    """A parsed rule entry."""

    type: str
    params: dict[str, Any]
    message: str | None
    enabled: bool


def parse_entry(entry: Any) -> RuleEntry:
    """Accept the two spellings: ``"notNull"`` or ``{"type": ..., ...}``."""
    if isinstance(entry, str):
        name, params, message, enabled = entry, {}, None, True
    elif isinstance(entry, Mapping):
        name = entry.get("type")
        params = {k: v for k, v in entry.items() if k not in METADATA_KEYS}
        message = entry.get("message")
        enabled = entry.get("enabled", True)
        if not isinstance(enabled, bool):
            raise InvalidValidationConfig(f"'enabled' must be a boolean, got {enabled!r}")
        if message is not None and not isinstance(message, str):
            raise InvalidValidationConfig(f"'message' must be a string, got {message!r}")
    else:
        raise InvalidValidationConfig(f"a rule entry is a name or a dict, not {entry!r}")
    if not name or not isinstance(name, str):
        raise InvalidValidationConfig("a rule entry needs a 'type'")
    d = RULES.get(name)
    if d is None:
        raise ValidatorNotFoundError(f"no rule named {name!r}; known rules: {', '.join(rule_names())}")
    if d.parameterised:
        if not params:
            raise InvalidValidationConfig(f"rule {name!r} takes parameters {list(d.params)}; none given")
        unknown = sorted(set(params) - set(d.params))
        if unknown:
            raise InvalidValidationConfig(
                f"rule {name!r} does not take {unknown}; it takes {list(d.params)}"
            )
    return RuleEntry(name, params, message, enabled)


def build_predicate(entry: RuleEntry, column: Column, dtype: T.DataType, sql_ref: str) -> Column:
    """Compile one row rule to its predicate (may be NULL; NULL = fail)."""
    d = RULES[entry.type]
    if d.build is None:
        raise InvalidValidationConfig(f"'{entry.type}' is a table-level rule; use it inside validate()")
    return d.build(column, dtype, entry.params, sql_ref)
