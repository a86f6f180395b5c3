"""Structured Streaming jobs over the event topics."""
