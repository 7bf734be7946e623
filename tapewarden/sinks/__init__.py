"""Sinks: messages, dead letters, keyed tables, relational targets."""
