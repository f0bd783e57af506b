"""Operators for training-data pipelines over ``documents``, ``conversations`` and ``embeddings``.

Nothing else in the library imports this subpackage.
"""
