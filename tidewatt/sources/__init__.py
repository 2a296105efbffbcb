"""Scans, file listings and the ledger of files already processed."""
