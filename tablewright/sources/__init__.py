"""Tables in and results out."""

from tablewright.sources.readers import CsvTable, read_csv, read_table, read_tables
from tablewright.sources.writers import write_evaluation, write_fixed, write_log, write_result

__all__ = ["CsvTable", "read_csv", "read_table", "read_tables", "write_evaluation", "write_fixed",
           "write_log", "write_result"]
