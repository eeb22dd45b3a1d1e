"""News and market analytics as PySpark DataFrame jobs."""
