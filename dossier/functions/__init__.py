"""Column-level helpers: each returns a ``Column`` built only from built-in functions."""
