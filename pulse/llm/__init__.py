"""Operators for preparing training corpora, their queries, and the pipeline's parts."""
