"""Vitrine: price-listing analytics as ordinary Spark DataFrame jobs."""
