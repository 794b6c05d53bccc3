"""The query catalogue: named plans over the driver tables and their DuckDB oracle SQL."""
