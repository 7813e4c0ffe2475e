"""Source schemas and the registry reports read their tables from."""
