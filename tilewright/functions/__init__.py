"""Column functions: tile grids, text and geometry."""
