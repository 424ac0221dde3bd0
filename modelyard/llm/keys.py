"""Identity and fold columns shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """128 bits that name a row by its id and text, nulls included.

    Rows equal in both are the same document to the operators.
    """
    parts = [F.col(doc_id).cast("string"), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull()]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)
