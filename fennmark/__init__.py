"""Document and retrieval analytics as PySpark DataFrame functions."""
