"""Operators: DataFrame in, DataFrame out. Documents are rows of (doc_id, jfull)."""
