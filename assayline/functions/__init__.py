"""Column functions: cleaning, flags and text."""
