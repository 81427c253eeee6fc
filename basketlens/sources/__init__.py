"""Table schemas, readers, the table registry and sinks."""
