"""Operators for building training corpora of language models.

Nothing outside this subpackage imports it; ``catalogue`` holds the queries and
SQL that ``__spark_entry__`` adds.
"""
