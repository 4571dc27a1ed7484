"""Streams: the layer functions on unbounded frames, and their sinks."""
