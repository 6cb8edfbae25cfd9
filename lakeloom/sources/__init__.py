from lakeloom.sources.bronze import read_batch, read_full
from lakeloom.sources.control import ControlRow, control_rows, extract, incremental_rows, unmarked_rows
from lakeloom.sources.delimited import read_csv
from lakeloom.sources.relational import JdbcSource, Split

__all__ = [
    "ControlRow",
    "JdbcSource",
    "Split",
    "control_rows",
    "extract",
    "incremental_rows",
    "read_batch",
    "read_csv",
    "read_full",
    "unmarked_rows",
]
