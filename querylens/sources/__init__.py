"""Reading the raw exports, incremental loads, and writing result tables."""
