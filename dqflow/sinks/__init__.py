from dqflow.sinks.writer import list_versions, read_latest, read_version, write_sink

__all__ = ["list_versions", "read_latest", "read_version", "write_sink"]
