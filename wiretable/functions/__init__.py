"""Column expressions (native Spark functions only) and the fixed rule values."""
