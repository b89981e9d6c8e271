"""Column expressions: text steps, lexicons, scores and record conversions."""
