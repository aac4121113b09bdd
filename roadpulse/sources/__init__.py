"""Readers and writers: files, streams and keyed tables."""
