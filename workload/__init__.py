"""Queries that run the operators over the driver's tables, with the SQL to check them."""
