"""The keyed merge as a stream."""
