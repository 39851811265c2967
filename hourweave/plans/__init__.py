"""Registered queries (``registry.QUERIES``) with their DuckDB oracles (``registry.ORACLES``)."""
