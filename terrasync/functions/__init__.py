"""Column functions: temporal, geometry, identifiers and units."""
