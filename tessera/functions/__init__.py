"""Column functions: casts and scalars."""
