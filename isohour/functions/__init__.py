"""Column functions: times, keys, measures."""
