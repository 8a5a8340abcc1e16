"""Structured Streaming: incremental load of a landing folder."""
