"""Operators bound to the driver tables: one Spark query and one DuckDB twin per inventory row."""
