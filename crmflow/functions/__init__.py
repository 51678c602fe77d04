"""Column functions whose meaning differs from the built-in of the same name."""
