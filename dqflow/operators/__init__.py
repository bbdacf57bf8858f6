from dqflow.operators.quality import flag_duplicates
from dqflow.operators.transforms import StepContext, apply_transform, list_transforms, register_transform
from dqflow.operators.validation import ValidationResult, apply_validations, compile_rules, validate

__all__ = [
    "StepContext",
    "ValidationResult",
    "apply_transform",
    "apply_validations",
    "compile_rules",
    "flag_duplicates",
    "list_transforms",
    "register_transform",
    "validate",
]
