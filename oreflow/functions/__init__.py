"""Column-level helpers; all of them are built-in expressions."""
