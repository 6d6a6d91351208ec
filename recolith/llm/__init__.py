"""Training-data operators: ten components for preparing text corpora at scale."""
