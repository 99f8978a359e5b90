"""Retail order analytics on Spark: clean, model, reconcile and report."""
