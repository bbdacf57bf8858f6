from dqflow.sources.inventory import check_sources, file_inventory, source_inventory
from dqflow.sources.reader import read_source, read_table

__all__ = ["check_sources", "file_inventory", "read_source", "read_table", "source_inventory"]
