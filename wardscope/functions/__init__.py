"""Column functions: cleaning, calendar, categories and numbers."""
