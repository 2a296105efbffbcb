"""Partitioned writes, quarantine output, snapshot tables and run summaries."""
