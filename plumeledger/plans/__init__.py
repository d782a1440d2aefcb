"""The analysis job, and the queries on the driver tables with their SQL."""
