"""DataFrame operators built from joins, grouping and range partitioning."""
