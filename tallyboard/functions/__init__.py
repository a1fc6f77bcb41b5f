"""Column expressions: weeks, lenient cleaning, guarded ratios, display text."""
