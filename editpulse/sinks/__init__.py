"""Writers: versioned count tables, finalised appends, JDBC, CSV, Kafka."""
