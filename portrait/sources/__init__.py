"""Sources and sinks: table readers, change records, streams."""
