"""Drive-health telemetry analytics on Spark: windowed temperature statistics and failure rankings."""

__version__ = "0.1.0"
