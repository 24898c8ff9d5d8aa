"""DataFrame operators: tokens, numbering, index tables, incremental state and lookups."""
