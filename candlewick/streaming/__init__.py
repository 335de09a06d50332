"""Structured Streaming over trade ticks."""
