"""Listing analytics on Spark."""
