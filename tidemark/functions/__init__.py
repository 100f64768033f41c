"""Column functions with the source dialect's NULL and error rules."""
