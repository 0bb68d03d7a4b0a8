"""Table-level operators: every function maps ``DataFrame`` to ``DataFrame``."""
