"""Whole runs: single batches, batch series with a ledger, and many batches in one pass."""
