"""sensorlytics: sensor-reading analytics on Spark DataFrames and Structured Streaming.

Readings are rows ``(urn STRING, value DOUBLE, timestamp BIGINT epoch-ms)``; jobs group them
into cells (one sensor, one tumbling window or calendar slot), compute per-cell statistics,
detect outliers (2 sigma or quartile rules), summarise, and publish payloads.
"""

from sensorlytics.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
