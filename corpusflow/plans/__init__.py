"""Registered queries (Spark side), their DuckDB oracle SQL, and the input
derivations both sides share."""
