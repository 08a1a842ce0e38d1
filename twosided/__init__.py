"""PySpark toolkit for records of two-sided contests: one row, a home and an away participant."""
