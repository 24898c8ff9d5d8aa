"""Readers and writers: source files, chunk trees, token sidecars, published indexes."""
