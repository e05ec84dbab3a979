"""Column builders (scalar cleaning, arrays, statistics)."""
