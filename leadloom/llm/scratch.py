"""Intermediate tables in the folder that driver and executors share: those of the library."""

from leadloom.sources.scratch import materialize, rows_of, scratch_path, scratch_root, table

__all__ = ["materialize", "rows_of", "scratch_path", "scratch_root", "table"]
