"""Structured Streaming variants of ingest, de-duplication and billing."""
