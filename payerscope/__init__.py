"""Payer-claims analytics expressed as Spark DataFrame, SQL and MLlib jobs."""
