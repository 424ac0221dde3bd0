"""Readers, writers and previews.

Paths are plain strings: local, HDFS or object-store URIs all go through the
same ``spark.read`` / ``df.write`` calls.  Object-store settings (endpoint,
credentials, upload tuning) belong in the session config of the cluster and
are never written here.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.numeric import quote


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


SPREAD_MIN_BYTES = int(os.environ.get("MODELYARD_SPREAD_MIN_BYTES", 4 << 20))


def spread(df: DataFrame, min_bytes: int = SPREAD_MIN_BYTES) -> DataFrame:
    """Spread a scan with fewer splits than task slots over all slots.

    A parquet file is split by row group; a file written as one row group is
    read by one task however large it is.  When such a scan is bigger than
    ``min_bytes`` it is repartitioned (round-robin) to the cluster's
    parallelism.  Filters and column pruning still reach the scan: Catalyst
    pushes them below the repartition.  A large table on a cluster already
    has more splits than slots, so there this is a no-op.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()  # noqa: SLF001
    if int(str(size)) < min_bytes:
        return df
    return df.repartition(slots, *[F.col(quote(c)) for c in df.columns])


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Load a named dataset (``get_data(name)``) as a parquet scan.

    No repartition here: callers project first, then may :func:`spread` the
    projected columns (a repartition on all columns would stop Catalyst from
    pruning the unused ones).
    """
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan with a header row.

    Without ``schema`` the types are inferred by an extra pass over the
    files (as the reference does); with one the pass is skipped, which is
    what a large job should do.
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)
    return path


def cast_like(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast columns to a reference schema (CSV inference narrows bigint to int)."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str | None = None,
               path: str | None = None, v2: bool = False) -> str:
    """Write a catalog table and return its name.

    ``v2=True`` uses ``DataFrameWriterV2.createOrReplace`` for catalogs that
    support it (v2 table catalogs); otherwise ``saveAsTable``, external at
    ``path`` when one is given (a shared folder on a cluster).
    """
    if v2:
        w = df.writeTo(name)
        if fmt:
            w = w.using(fmt)
        w.createOrReplace()
        return name
    writer = df.write.mode(mode)
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def preview(df: DataFrame, keys: Sequence[str], n: int = 20,
            truncate: int | None = 20) -> DataFrame:
    """First ``n`` rows by ``keys`` (a top-k), strings cut to ``truncate``.

    Unlike ``show()`` the rows are fixed by the keys, so the preview is
    repeatable.  ``truncate=None`` keeps cells whole.
    """
    top = df.orderBy(*keys).limit(n)
    if truncate is None:
        return top
    return top.select(*[
        F.substring(F.col(f.name), 1, truncate).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in top.schema.fields])
