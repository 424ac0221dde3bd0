"""Session set-up and the shared folders jobs write to.

The library never creates a session on its own in library code paths; it
only reads settings from the one it is given.  ``local_session`` exists for
tests, the benchmark and the entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "modelyard") -> SparkSession:
    """A local session with the settings every test and bench run shares.

    AQE stays on so shuffle partition counts adapt at run time; the UI is
    off (no listening port); time zone is pinned to UTC for oracle parity.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MODELYARD_DRIVER_MEMORY", "16g"))
        # Wide aggregates (many models x metrics) generate large methods;
        # let the JIT compile them instead of interpreting.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    jsc = spark.sparkContext._jsc  # noqa: SLF001 - public py4j handle
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set one only where none is set.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store).  A machine-local temporary folder is only used when the
    session runs in local mode, as in tests.
    """
    root = checkpoint_root(spark)
    if root:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():  # noqa: SLF001
            spark.sparkContext.setCheckpointDir(root)
        return root
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(e.g. an HDFS or object-store path) before running jobs that "
            "cut lineage")
    root = tempfile.mkdtemp(prefix="modelyard-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def written_table(df, name: str):
    """``df`` written below the shared checkpoint root and read back: computed once, kept on loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``modelyard`` importable in executor Python workers.

    Zips the package once per application and registers it with
    ``addPyFile`` (what ``spark-submit --py-files`` does), so pandas/Arrow
    functions defined here unpickle on any worker, wherever the driver was
    started.
    """
    import os
    import zipfile
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="modelyard-pkg-"), "modelyard.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)
