"""Signal-telemetry analytics on Spark: events in, current status per intersection out."""

__version__ = "0.1.0"
