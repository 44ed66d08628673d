"""Column functions and rendering."""
