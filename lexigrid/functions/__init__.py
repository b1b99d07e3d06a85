"""Column expressions: row-local, no shuffle."""
