"""Community analytics as PySpark DataFrame functions."""
