"""Column expressions: time, text and labels."""
