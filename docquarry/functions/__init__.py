"""Column expressions and fixed values; nothing here starts a job."""
