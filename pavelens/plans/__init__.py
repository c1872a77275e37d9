"""plans of pavelens."""
