"""hearthstream: a telemetry data pipeline written as plain PySpark DataFrame functions."""
