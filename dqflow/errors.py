"""Exception hierarchy.

Two families, mirroring the two kinds of user input the engine checks:
table steps (``TransformationError``) and rule definitions
(``ValidationException``).  All checks run on the driver before any
Spark job is started.
"""

from __future__ import annotations


class TransformationError(Exception):
    """Base class for table-step errors."""


class ValidationError(TransformationError):
    """A step was given missing or malformed parameters."""


class ExecutionError(TransformationError):
    """A step failed while building its DataFrame."""


class ValidationException(Exception):
    """Base class for rule-definition errors."""


class ValidatorNotFoundError(ValidationException):
    """A rule names a type that is not registered."""


class InvalidValidationConfig(ValidationException):
    """A rule or rule block is malformed."""


class SinkError(RuntimeError):
    """A sink could not be written."""
