"""Query catalogue: Spark queries (``catalog``) and their DuckDB oracle SQL
(``oracle``) over the driver tables."""
