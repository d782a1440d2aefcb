"""DataFrame -> DataFrame operators: keyed rows, rollups, rankings, owners, lookups."""
