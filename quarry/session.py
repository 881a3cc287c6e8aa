"""Session construction and the shared scratch folder.

On a cluster the operator of the cluster names a shared folder in
``spark.checkpoint.dir``; every lineage cut and every intermediate file of
this library goes below it. Only when it is unset (local runs, tests) do we
pick a folder of our own.
"""

from __future__ import annotations

import gc
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only in local mode.

    ``SparkContext.setCheckpointDir`` is called only when no checkpoint
    folder is active yet (it adds a fresh sub-folder on every call).
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    d = _checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors; "
                               "a machine-local temporary folder does not work on a cluster")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return (spark.sparkContext.getCheckpointDir() or d).rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable for Python workers that were not given it
    (``--py-files``, ``PYTHONPATH``): once per application, its source goes as
    a zip below the shared folder and from there to the executors."""
    sc = spark.sparkContext
    root = Path(__file__).parent
    if sc.applicationId in _shipped or not root.is_dir():
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = f"{fresh_path(spark, 'package')}/quarry_source.zip"
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to)
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def written_table(df, tag: str):
    """Write ``df`` once as parquet below the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` but in a single job, and the file
    survives executor loss; use it when the partitioning need not be kept.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop_written(*tables) -> None:
    """Delete tables that ``written_table`` made and no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_unused(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffles and cached blocks that nothing refers to any more.

    The cleaner learns of them when the driver collects garbage, by itself every
    30 minutes; until then the files of finished steps stay on the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BROADCAST_ROWS = 2_000_000     # largest counted table sent whole to every task,
BROADCAST_BYTES = 128 << 20    # and its strings and numbers in bytes


def bounded_side(df, rows: int, bound: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES):
    """Join side with a counted size: broadcast under ``bound`` rows and
    ``max_bytes``, else a sort-merge join. A table written as parquet
    compresses well, so Spark's size estimate from its files can be far below
    its size in memory; the exact row count, and the counted length of its
    text and binary columns, decide instead of that estimate."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import BinaryType, StringType

    if rows > bound:
        return df.hint("merge")
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType | BinaryType)]
    size = rows * 24 * len(df.columns)
    if texts:
        size += df.agg(F.sum(sum(texts[1:], texts[0]).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df.hint("merge")
