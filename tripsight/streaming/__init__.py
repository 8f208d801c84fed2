"""Structured Streaming: scoring, windowed telemetry, idempotent input."""
