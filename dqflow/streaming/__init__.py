from dqflow.operators.quality import Horizon
from dqflow.streaming.validate_stream import start_failure_totals, start_validated_stream, validate_stream

__all__ = ["Horizon", "start_failure_totals", "start_validated_stream", "validate_stream"]
