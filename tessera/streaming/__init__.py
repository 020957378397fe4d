"""Streams: the batch operators run incrementally."""
