"""A PySpark-native text corpus engine: citation chunks, tokens, match keys, postings and lookups as DataFrames."""
