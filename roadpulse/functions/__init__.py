"""Column expressions. Nothing here starts a job or runs Python on rows."""
