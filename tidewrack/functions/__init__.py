"""Column expressions shared by batch and stream. No Python UDFs."""
