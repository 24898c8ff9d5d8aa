"""Whole runs (compile, tokenize, analyze, index) and the query registry."""
