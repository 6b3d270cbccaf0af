"""Structured Streaming loader for a landing folder of series documents."""
