"""Tidewatt: telemetry curation, price history, vault, billing facts and metrics on Spark."""
