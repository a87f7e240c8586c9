"""File listings, schema-grouped scans and partitioned layer tables."""
