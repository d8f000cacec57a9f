"""Sinks: payload builders (JSON / CSV text) and partitioned, idempotent writers."""
