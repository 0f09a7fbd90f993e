"""Retail price and sales analytics as Spark DataFrame jobs."""
