"""Column functions: match keys, URNs, ordering keys, text samples and segments."""
