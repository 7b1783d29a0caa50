"""Streaming twins of the training-log analytics."""
