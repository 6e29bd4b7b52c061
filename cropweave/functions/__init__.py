"""Column expressions: ``Column -> Column``, no actions."""
