"""Batch/stream DataFrame operators: transforms, partitioning, windows, joins, ordered state."""
