"""Change-data-capture analytics expressed as plain Spark DataFrame functions."""
