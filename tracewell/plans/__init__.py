"""Named queries over the tables, and their DuckDB counterparts."""
