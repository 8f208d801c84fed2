"""Scans, adapters, ingestion guards and sinks."""
