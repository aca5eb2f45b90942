"""Sources and sinks: Kafka messages, layer tables, the fixture made from ``events``."""
