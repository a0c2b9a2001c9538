"""Column expressions: text, casts, JSON, HTML, geometry."""
