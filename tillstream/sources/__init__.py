"""Sources and sinks: layered tables, the order topic, views over given tables."""
