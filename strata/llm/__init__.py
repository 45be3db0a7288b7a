"""Operators of a training-data pipeline over ``documents``, ``labels`` and ``embeddings``.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` applies them to the
tables with production parameters and derives the contract's columns.
"""
