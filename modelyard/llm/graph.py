"""Connected components of a link table, as repeated DataFrame joins."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Drops a query's shuffle files when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession):
    """Queries run inside drop their shuffles at their end; nothing may read them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table every executor can see, so a lost executor
    costs a re-read and not a recomputation.  The shuffles of the write are
    dropped at its end; nothing reads them again.
    """
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with dropped_shuffles(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _flat(hooks: DataFrame) -> DataFrame:
    """``hooks(node, root)``, one smaller root a node, followed to their ends by pointer jumping."""
    labels = written(hooks, "labels")
    while True:
        jump = labels.select(F.col("node").alias("j_node"), F.col("root").alias("j_root"))
        further = labels.join(jump, labels.root == jump.j_node)
        if not further.limit(1).count():
            return labels
        labels = written(labels.join(jump, labels.root == jump.j_node, "left")
                         .select("node", F.coalesce("j_root", "root").alias("root")), "labels")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the least node.

    Each round every node with a smaller neighbour hooks onto the least one, and
    its other smaller neighbours are linked to that one instead (one link for all
    nodes that lie between the same two); hooks are followed to their ends, and
    what is left are links between those ends.  So a link is read once, and
    a group costs one row a node and round.  Labels stay in DataFrames; the
    driver only learns whether links are left.  Null ends are ignored; an empty
    table gives an empty result.
    """
    def distinct_links(pairs):
        return written(pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                       .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    edges, labels = distinct_links(links.select("a", "b")), None
    while labels is None or edges.limit(1).count():
        stars = written(edges.withColumn("least", F.min("b").over(Window.partitionBy("a"))), "stars")
        hooks = _flat(stars.where("b = least").select(F.col("a").alias("node"), F.col("b").alias("root")))
        to_a = hooks.select(F.col("node").alias("a"), F.col("root").alias("to_a"))
        to_b = hooks.select(F.col("node").alias("b"), F.col("root").alias("to_b"))
        between = stars.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        edges = distinct_links(between.join(to_a, "a", "left").join(to_b, "b", "left")
                               .select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")))
        if labels is None:
            labels = hooks
        else:
            next_ = hooks.select(F.col("node").alias("n_node"), F.col("root").alias("n_root"))
            labels = written(labels.join(next_, labels.root == next_.n_node, "left")
                             .select("node", F.coalesce("n_root", "root").alias("root"))
                             .unionByName(hooks), "labels")
    return labels.unionByName(labels.select(F.col("root").alias("node"), "root").distinct())
