"""Training rows: documents joined to their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A label row is an id and an int; below this many rows the table is under 32 MB.
SMALL_LABELS = 1_000_000


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, keep,
                  text_col: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, text, label)`` of the rows for which ``keep`` holds.

    Null labels are skipped; an id with several label rows gives one row each.
    The labels are broadcast only when a count shows they are few; else both
    sides are shuffled on the id.
    """
    known = (labels.select(F.col(doc_id).alias("mk_id"),
                           F.col(label_col).cast("int").alias("label"))
             .where("label IS NOT NULL AND mk_id IS NOT NULL"))
    if known.limit(SMALL_LABELS + 1).count() <= SMALL_LABELS:
        known = F.broadcast(known)
    rows = docs.where(keep).select(F.col(doc_id).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.join(known, rows.doc_id == F.col("mk_id")).drop("mk_id")
