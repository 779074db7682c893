"""Column functions: ``Column -> Column``."""
