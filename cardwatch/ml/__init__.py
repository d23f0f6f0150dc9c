"""Distributed training, comparison and versioning of classifiers."""
