"""operators of pavelens."""
