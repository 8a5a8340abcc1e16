"""Column functions: sector and state labels, time arithmetic, exact decimals."""
