"""Structured Streaming: the batch operators, run for each micro-batch, and keyed state."""
