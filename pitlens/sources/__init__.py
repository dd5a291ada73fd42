"""Readers of raw market files and writers of results."""
