"""Operators for training data, and their queries (``queries.QUERIES`` and ``queries.SQL``)."""
