"""Session settings and the shared folder for materialised state."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library assumes.  UTC session time so that
# TIMESTAMP values render like the reference's timestamptz columns; AQE so
# that shuffle partition counts, join strategies and skewed partitions are
# re-planned from runtime sizes instead of guesses.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only what Spark's size estimate (or AQE's runtime size)
    # proves small; never force it with a hint on a side that grows.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their RDD is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "tempora",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Reports render TIMESTAMP values in UTC, like the reference sessions."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and written tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a
    distributed file system).  Only when nothing is configured - local tests -
    do we create a private folder and register it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tempora-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def checkpointed(df):
    """Reliable checkpoint into the shared folder (cuts lineage; survives
    executor loss, unlike a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` for listing and deleting directories."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (any Hadoop file system), replacing what is there."""
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it is missing)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


_OWN_DIRS: set[str] = set()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder, unique to this call; deleted when the application ends."""
    import uuid

    own = f"{shared_dir(spark)}/tempora/{spark.sparkContext.applicationId}"
    if own not in _OWN_DIRS:
        fs, p = hadoop_fs(spark, own)
        fs.mkdirs(p)
        fs.deleteOnExit(p)  # needs the folder to be there
        _OWN_DIRS.add(own)
    return "/".join([own, *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (any Hadoop file system)."""
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


__all__ = ["build_session", "ensure_utc", "shared_dir", "scratch_path", "exists", "local_path",
           "checkpointed", "hadoop_fs", "delete_path", "list_dirs", "read_text", "write_text",
           "DEFAULT_CONF"]
