"""Column functions: exact decimals, time arithmetic, text."""
