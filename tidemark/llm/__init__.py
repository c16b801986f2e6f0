"""Operators for training-data pipelines over text, embeddings and urls.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
