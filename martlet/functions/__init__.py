"""Column-expression functions (scalar, date/time, calendar)."""
