"""Sources and sinks: parquet, CSV, JDBC readers, the table catalog, writers."""
