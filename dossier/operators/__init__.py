"""DataFrame operators grouped by domain."""
