"""Column expressions: cleaning, dates and numeric rules."""
