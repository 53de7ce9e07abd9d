"""Card-payment clearing and settlement as PySpark DataFrame jobs."""
