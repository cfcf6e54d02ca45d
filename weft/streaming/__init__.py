"""Incremental state: streaming progress, resume and append-only ledgers."""
