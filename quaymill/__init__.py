"""Spark operators that refine fact tables through bronze, silver and gold layers."""
