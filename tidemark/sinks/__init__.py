"""Sinks: text/parquet files, foreach writers, JDBC, Kafka and Cassandra option sets."""
