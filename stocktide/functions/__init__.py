"""Column functions: numbers, dates and business measures."""
