"""Column expressions and calendars."""
