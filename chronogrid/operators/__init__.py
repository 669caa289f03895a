"""DataFrame-in, DataFrame-out operators on grid, axis, cell and catalog tables."""
