"""Structured Streaming re-aims of the additive derived state (STR-01 … STR-03)."""
