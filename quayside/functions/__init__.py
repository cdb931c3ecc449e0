"""Column and name functions."""
