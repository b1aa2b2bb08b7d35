"""Column functions: typed tag columns, geometry and tiles."""
