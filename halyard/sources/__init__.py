"""Sources and sinks: files, versioned tables, incremental loads."""
