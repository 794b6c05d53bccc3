"""Scalar column functions (JVM-side Catalyst expressions only)."""
