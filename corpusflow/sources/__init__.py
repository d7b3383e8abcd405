"""Sources: Parquet tables, object folders, JDBC, message streams, landed API JSON."""
from corpusflow.sources.tables import read_table, TABLES

__all__ = ["read_table", "TABLES"]
