"""dqflow: rule-driven table dataflows and data-quality checks on Spark.

A dataflow names sources, applies ordered table steps (filter, derive,
select, rename, drop, add fields, validate) and writes sinks.  Everything is
a plain DataFrame; Catalyst plans it.
"""

from dqflow.errors import (
    ExecutionError,
    InvalidValidationConfig,
    SinkError,
    TransformationError,
    ValidationError,
    ValidationException,
    ValidatorNotFoundError,
)
from dqflow.functions.rules import register_rule, rule_names
from dqflow.operators.quality import flag_duplicates
from dqflow.operators.transforms import StepContext, apply_transform, register_transform
from dqflow.operators.validation import ValidationResult, apply_validations, rule_predicate, validate
from dqflow.plans.dataflow import build_flow, run
from dqflow.sinks.writer import list_versions, read_latest, read_version, write_sink
from dqflow.sources.inventory import check_sources, file_inventory, source_inventory
from dqflow.sources.reader import read_source

__version__ = "0.1.0"

__all__ = [
    "ExecutionError",
    "InvalidValidationConfig",
    "SinkError",
    "StepContext",
    "TransformationError",
    "ValidationError",
    "ValidationException",
    "ValidationResult",
    "ValidatorNotFoundError",
    "apply_transform",
    "apply_validations",
    "build_flow",
    "check_sources",
    "file_inventory",
    "flag_duplicates",
    "list_versions",
    "read_latest",
    "read_source",
    "read_version",
    "register_rule",
    "register_transform",
    "rule_names",
    "rule_predicate",
    "run",
    "source_inventory",
    "validate",
    "write_sink",
]
