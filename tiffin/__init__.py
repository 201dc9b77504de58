"""Order, delivery and review analytics as PySpark DataFrame jobs."""
