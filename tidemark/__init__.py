"""tidemark: event-stream analytics as Spark DataFrame / Structured Streaming operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions, windows, joins and aggregations; the same function serves batch
DataFrames and, where Spark allows, streaming ones.
"""

__version__ = "0.1.0"
