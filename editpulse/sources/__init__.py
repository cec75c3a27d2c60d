"""Readers: captured text streams, Kafka, JDBC, stored count tables and the
driver's test tables."""
