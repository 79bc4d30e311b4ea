"""Structured Streaming variant of the config-driven ingestion."""
