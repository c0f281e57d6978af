"""Metadata-governance analytics on Spark: every operator is a lazy DataFrame job."""
