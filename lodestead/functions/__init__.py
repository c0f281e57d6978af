"""Spark jobs; see the modules."""
