"""Readers and writers: payload files, month-partitioned tables, seeds, state."""
