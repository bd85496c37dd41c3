"""Registered queries (``catalog``) and their DuckDB oracle SQL (``oracle``)."""
