"""Operators for training-data pipelines: deduplication, quality, toxicity,
mixing and tokenisation over tables of documents. Nothing outside this
subpackage imports it."""
