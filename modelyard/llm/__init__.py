"""Operators for building training data: filtering, deduplication, tokens, shards.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
