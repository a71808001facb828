"""Streaming use of the stateless operators (the reference itself has no streams)."""
