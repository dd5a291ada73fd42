"""Incremental builds: watermarks over batches, and a stream of new files."""
