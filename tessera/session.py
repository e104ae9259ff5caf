"""Session construction and the shared scratch location.

Cluster jobs must never write to a machine-local temporary folder: executors
can be lost and another machine must be able to read what was written.  Every
file this library writes goes under ``spark.checkpoint.dir`` (the shared folder
the cluster names), which is read from the session.  Only when it is unset and
the master is one machine, as in tests, it is a folder below the warehouse.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings chosen for scale, not for the laptop: AQE re-plans joins and
# partition counts from runtime statistics, splits skewed join partitions and
# turns joins into broadcasts only when the measured side is small.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # No broadcast from compile-time estimates (they are wrong after explode
    # and aggregates and would broadcast tables that grow with the data);
    # AQE broadcasts a join side only when its measured shuffle output is
    # under the adaptive threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go with the last reference to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder every "
                               "executor can reach (HDFS, object store)")
        # One machine: the warehouse folder is where its tables lie already.
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tessera-{purpose}-{uuid.uuid4().hex}"
    for names in _open:
        names.append(path)
    return path


_open: list[list[str]] = []  # the folders named inside each open ``dropping``


@contextmanager
def dropping(spark: SparkSession):
    """Remove, at the end, the folders that what runs inside has written to the shared
    location: tables stored on the way, ledgers, archives, token files.  Results have to be
    written elsewhere before that.  Gives the list of the folders."""
    names: list[str] = []
    _open.append(names)
    try:
        yield names
    finally:
        _open[:] = [other for other in _open if other is not names]
        for name in names:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def reliable_checkpoint(df):
    """Materialise ``df`` into the shared checkpoint folder and cut its
    lineage (a lost executor then re-reads files instead of recomputing the
    whole plan).  Never ``localCheckpoint``: that lives on executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, purpose: str):
    """Write ``df`` once as Parquet into the shared folder and read it back: lineage is
    cut as by a checkpoint, and readers take only the columns they need."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark) -> None:
    """Let Spark remove the shuffle files of what is done: its cleaner does so once the
    driver's JVM has collected the plans, which a JVM with room to spare puts off."""
    spark.sparkContext._jvm.System.gc()


MAX_BROADCAST_BYTES = 32 << 20


def measured_bytes(df) -> int:
    """Bytes of ``df``'s rows, counted in one aggregate: 16 for each value and row,
    and what strings and arrays of strings hold."""
    from pyspark.sql import functions as F
    size = F.lit(16 * (len(df.columns) + 1)).cast("bigint")
    for c, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
        elif kind not in ("bigint", "int", "double", "float", "boolean", "smallint", "tinyint", "date"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0))
    return df.agg(F.sum(size).alias("b")).first()["b"] or 0


def broadcast_limit(df, max_bytes: int | None = None) -> int:
    """``max_bytes``, or else the session's ``tessera.broadcast.maxBytes``."""
    if max_bytes is not None:
        return max_bytes
    return int(df.sparkSession.conf.get("tessera.broadcast.maxBytes", str(MAX_BROADCAST_BYTES)))


def fits_broadcast(df, max_bytes: int | None = None) -> bool:
    """Whether the measured bytes of ``df`` (stored, as it is read again) are few."""
    return measured_bytes(df) <= broadcast_limit(df, max_bytes)


def broadcast_stored(df, max_bytes: int | None = None):
    """``broadcast_if_small`` for rows that are stored already."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def broadcast_if_small(df, max_bytes: int | None = None):
    """The one rule for broadcasts: ``df`` is written to the shared folder, its
    bytes are counted, and only within the limit is it marked for broadcast;
    otherwise the join stays a shuffle join."""
    return broadcast_stored(reliable_checkpoint(df), max_bytes)
