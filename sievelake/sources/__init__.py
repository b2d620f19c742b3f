"""Readers: trips, file manifests, the run ledger and the batch history."""
