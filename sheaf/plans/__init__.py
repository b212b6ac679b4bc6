"""Named queries over the driver tables, their DuckDB oracle SQL, and the registry."""
