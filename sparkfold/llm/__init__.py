"""Operators for large training-text pipelines: token files, filters, dedup, packing, classifiers."""
