from lakeloom.sinks.bronze import write_batch, write_full, write_unmarked
from lakeloom.sinks.tables import MergeCounts, Table

__all__ = ["MergeCounts", "Table", "write_batch", "write_full", "write_unmarked"]
