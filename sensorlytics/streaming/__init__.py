"""Structured Streaming versions of the jobs: sources, idempotent sinks, stream jobs."""
