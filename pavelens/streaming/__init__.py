"""streaming of pavelens."""
