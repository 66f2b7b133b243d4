"""Session construction and shared-folder resolution.

On a cluster the session is built by the platform; library code only reads
settings from it.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  They are defaults: anything
# the platform already set on the session wins.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "folio",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a local session for tests and benchmarks."""
    master = master or os.environ.get("FOLIO_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    for getter in (lambda: spark.conf.get("spark.checkpoint.dir", None),
                   lambda: sc.getConf().get("spark.checkpoint.dir", None)):
        try:
            value = getter()
        except Exception:  # pragma: no cover - conf access differs by mode
            value = None
        if value:
            return value
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value is
    always used.  Only a ``local`` master (tests, benchmarks) gets a temporary
    folder of its own: elsewhere executors could not share it, so a missing
    setting is an error.
    """
    sc = spark.sparkContext
    configured = checkpoint_dir(spark)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not is_local(sc.master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
    local = tempfile.mkdtemp(prefix="folio-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def is_local(master: str) -> bool:
    """One process holds driver and executors."""
    return master == "local" or master.startswith("local[")


# Scratch folders of this application that are still there.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def finished_parts(spark: SparkSession, path: str) -> list[str]:
    """Folders under ``path`` whose write was finished (they have a success mark), by name; none if there is no ``path``."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = make(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(p.toString() for p in found if fs.exists(make(p, "_SUCCESS")))


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders (stage tables, round trips).

    For the end of a job, when no frame that reads them is used any more."""
    for path in list(_SCRATCH):
        delete_path(spark, path)


def reliable_checkpoint(df, name: str = "stage"):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return the table read back: lineage is cut there and the data survives
    executor loss (it lives on the shared file system, not on executors).

    A written table is used rather than ``DataFrame.checkpoint()``: an eager
    RDD checkpoint computes the plan twice (once to count, once to write),
    while a table write computes it once and gives the optimizer real file
    sizes for its broadcast and skew decisions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
