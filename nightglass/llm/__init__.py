"""Training-data operators: quality, duplicates, contamination, privacy, mixing, sharding and formatting."""
