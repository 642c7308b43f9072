"""Session construction and shared scratch locations.

Library code never creates its own session; it receives one.  ``get_spark``
is for tests, the bench and the CLI.  ``shared_dir`` resolves the folder the
cluster names in ``spark.checkpoint.dir`` so that written intermediates and
checkpoints survive the loss of an executor; a private folder is only set up
when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for correctness (UTC dates) and for plan quality
# (AQE re-plans joins/partition counts at runtime, skew-join splits hot keys).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_settings(shuffle_bytes: float, cores: int,
                   advisory_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Partition-related settings for a job that shuffles about ``shuffle_bytes``.

    The initial shuffle partition count is sized so that each partition is
    about ``advisory_bytes`` (and at least 2 tasks per core); AQE then
    coalesces small partitions and splits skewed ones at runtime, so one
    setting holds from a test run to a 100 TB run.  Scans use the same
    split size.  Example: 100 TB of shuffle on 1000 executors x 8 cores ->
    about 400k partitions of 256 MB.
    """
    parts = max(2 * cores, int(-(-shuffle_bytes // advisory_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(advisory_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.files.maxPartitionBytes": str(advisory_bytes // 2),
        # broadcast only what is clearly small; everything else sort-merge + AQE
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "popcorr", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir).
    Only when neither is set on a local master - a local run or a test - a
    fresh private folder is created and registered, so that
    ``DataFrame.checkpoint()`` works.  On any other master a machine-local
    folder would be seen by one machine only, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            opt = spark.sparkContext._jsc.sc().getCheckpointDir()
            root = opt.get() if opt.isDefined() else None
        except Exception:  # pragma: no cover - non-classic sessions
            root = None
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="popcorr-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover
        pass
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root.

    Used for written intermediates (round trips, serving/live tables of the
    registered queries).  Each call gets its own sub-folder so that nothing
    is ever deleted or overwritten between runs.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/popcorr/{name}/{uuid.uuid4().hex}"


#: Bytes of a method that the JVM still compiles.
COMPILED_BYTES = 8000


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside."""
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compiled(spark: SparkSession):
    """For jobs run inside whose rows have many computed columns: where a stage's generated method would be too long for
    the JVM to compile, and so be interpreted row by row, its operators run by themselves in short methods instead."""
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": str(COMPILED_BYTES)})


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder.

    One computation (an eager ``checkpoint()`` computes the plan twice unless
    cached), reliable storage that survives executor loss (never a local
    checkpoint), and the re-read carries real file statistics for the
    optimizer's broadcast decisions.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Deletes the folders that ``cut_lineage`` wrote for ``frames``, once whatever reads them is written itself.

    Only folders below the session's own part of the shared checkpoint folder are touched.
    """
    for df in frames:
        spark = df.sparkSession
        own = f"{checkpoint_root(spark).rstrip('/')}/popcorr/"
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if re.sub(r"^\w+:/*", "/", own) in re.sub(r"^\w+:/*", "/", folder) + "/":
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def listing(spark: SparkSession, path: str) -> tuple:
    """(file, bytes, modification time) of all files below ``path``: changes when the data there do."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files, out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
