"""Operators for preparing language-model training data.

Ten operators over the tables ``documents``, ``pages``, ``benchmark``,
``labels`` and ``conversations``. Nothing outside this package imports it; the
queries are registered by ``__spark_entry__.py`` when it is there.
"""
