"""Structured Streaming twins of the batch operators and transformWithState processors."""
