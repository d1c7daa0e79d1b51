"""Operators for preparing training data at scale; nothing outside this
subpackage (but the entry file and corpus_pipeline.py) imports it."""
