"""Batch vector, full-text and hybrid search, search-quality and operation-log analytics on Spark."""
