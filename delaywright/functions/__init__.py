"""Column expressions: calendar, cyclical, flag, clean-up."""
