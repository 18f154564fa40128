"""Composite jobs a user calls (PIP1-PIP15), the query catalog and the
DuckDB oracle texts."""
