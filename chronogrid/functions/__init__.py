"""Column-level functions (time axis, values, geometry)."""
