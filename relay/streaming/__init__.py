"""Structured Streaming: a delivery per micro-batch with staged results."""
