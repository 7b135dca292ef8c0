"""DataFrame operators of the core."""
