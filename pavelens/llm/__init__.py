"""Operators for training-data work; nothing else in pavelens imports this subpackage."""
