"""Spark-first record linkage, provenance and directory analytics."""
