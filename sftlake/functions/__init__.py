"""Column functions: text, scoring, schedules and names."""
