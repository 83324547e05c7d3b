"""Readers of captured reviews; every reader returns the same columns."""
