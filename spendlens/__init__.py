"""Monetisation and engagement metrics for mobile apps, as Spark DataFrame plans."""
