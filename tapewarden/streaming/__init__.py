"""Structured Streaming jobs over the same operators as the batch plans."""
