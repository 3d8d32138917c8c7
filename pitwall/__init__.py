"""pitwall: telemetry analytics on Spark."""
