"""Streaming use of the fitted, stateless operators (no streaming in the original)."""
