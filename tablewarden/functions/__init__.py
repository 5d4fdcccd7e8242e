"""Column functions: masks, text, calendar and pattern helpers."""
