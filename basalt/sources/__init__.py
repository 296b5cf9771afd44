"""Sources: Parquet tables, catalog checks, delimited text (vectors, edge lists, labels)."""
