"""Property-listing analytics as plain PySpark DataFrame functions."""
