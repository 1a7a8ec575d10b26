"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only sets
options that are still unset, so cluster-level settings always win.
"""

from __future__ import annotations

import contextlib
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on. They are applied only when the session does
# not define them already.
DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Top-k per group is planned as a partial WindowGroupLimit before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # Texts are long: smaller Arrow batches than Spark's default keep a worker's memory low.
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2000")
    # Rows of several MB (very long texts, blocks of a corpus) do not pile up in one batch.
    if spark.conf.get(ARROW_BYTES, None) in (None, "", "-1"):
        spark.conf.set(ARROW_BYTES, "8m")
    # Timestamps are rendered and truncated in UTC everywhere.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cartwheel`` importable in the Python workers (as ``--py-files`` would).

    The Arrow/NumPy task functions are pickled by reference to this package,
    so executors need it. Once per SparkContext the package's sources are
    zipped (code only, no data) and handed to ``addPyFile``.
    """
    import os
    import zipfile

    import cartwheel

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(cartwheel.__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="cartwheel-code-"), "cartwheel.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, small shuffle fan-out."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cartwheel")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def single_machine(spark: SparkSession) -> bool:
    """Driver and tasks share one machine and its folders (``local`` and ``local[n]``, not ``local-cluster``)."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; jobs cut lineage into it. Where it is unset, only a session on
    a single machine gets a folder of its own (see ``local_checkpoints``); anything else raises.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    if value:
        return value
    return local_checkpoints(spark)


def local_checkpoints(spark: SparkSession) -> str:
    """A checkpoint folder for a session on a single machine (tests, the bench, a laptop)."""
    if not single_machine(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for the cluster")
    value = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    spark.conf.set("spark.checkpoint.dir", value)
    spark.sparkContext.setCheckpointDir(value)
    return value


def ensure_checkpointing(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: set the context folder from the conf."""
    path = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for staged files."""
    import uuid
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/cartwheel-scratch/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files on disk (they would stay until the driver collects its garbage)."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df, name: str):
    """``df`` as a Parquet table under the shared checkpoint folder: computed once, readable by every executor."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
