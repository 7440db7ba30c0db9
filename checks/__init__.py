"""Registered queries over the driver's tables and the SQL their results are checked against."""
