"""sources of pavelens."""
