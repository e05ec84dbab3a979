"""DataFrame -> DataFrame operators, grouped by reference part."""
