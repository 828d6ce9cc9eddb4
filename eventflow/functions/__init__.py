"""Column-level helpers built only from Spark built-in functions (no UDFs)."""
