"""Tables that are written and read back leave nothing else behind."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from modelyard.llm import phrases
from modelyard.llm.graph import written

from ..conftest import spark  # noqa: F401


@pytest.mark.parametrize("write", [written, phrases._kept])  # noqa: SLF001
def test_a_written_table_leaves_no_shuffle_files(spark, write):  # noqa: F811
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()  # noqa: SLF001
        return blocks.diskBlockManager().getAllFiles().size()

    before = files()
    out = write(spark.range(100_000).repartition(8, "id").groupBy((F.col("id") % 1000).alias("k")).count(), "t")
    for _ in range(100):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert out.count() == 1000


@pytest.mark.parametrize("kind, width", [(np.int32, None), (np.uint8, None), (np.uint16, None), (np.int64, 3)])
def test_packed_numbers_come_back(kind, width):
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        rows = rng.integers(0, np.iinfo(kind).max, (n, width or 1)).astype(kind)
        rows = rows if width else rows.ravel()
        back = phrases._unpacked(phrases._packed(rows), n, kind, width)  # noqa: SLF001
        assert back.dtype == rows.dtype and back.shape == rows.shape and (back == rows).all()


def test_dealt_phrases_travel_small():
    """Places of words in 64 bits and counts of a few: under a quarter of the plain numbers."""
    rng, n, k = np.random.default_rng(2), 50_000, 2
    names = rng.integers(0, 1 << 16, (n, k)) | 5 << 24
    counts = rng.integers(1, 9, n)
    found = pa.RecordBatch.from_arrays(
        [pa.array([n]), pa.array([phrases._packed(names)]), pa.array([phrases._packed(counts)])],  # noqa: SLF001
        names=["n", "names", "counts"])
    (out,) = phrases._dealt(k, 3)([found])  # noqa: SLF001
    assert sum(out.column("n").to_pylist()) == n
    assert sum(map(len, out.column("rows").to_pylist())) < 8 * (k + 1) * n / 4
