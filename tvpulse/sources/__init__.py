"""Sources and sinks: typed readers, the test-data adapter and writers."""
