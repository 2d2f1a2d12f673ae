"""Event-time windows that work on batch and streaming DataFrames, and stream runners."""
