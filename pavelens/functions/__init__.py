"""functions of pavelens."""
