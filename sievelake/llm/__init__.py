"""Operators for training data: mixing, licenses, near and exact copies, leaks, quality, archives, tokens."""
