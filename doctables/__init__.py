"""Office documents as tables, processed with PySpark DataFrames."""

__version__ = "0.1.0"
