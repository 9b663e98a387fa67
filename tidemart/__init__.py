"""Retail lake analytics expressed as Spark DataFrame plans."""
