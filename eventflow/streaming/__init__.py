"""Structured Streaming over the same operators as the batch side."""
