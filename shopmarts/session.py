"""Session settings and the shared scratch location.

The marts rely on three settings: a pinned session time zone (month labels), ANSI mode
(Spark 4 default; ``try_*`` functions are used where NULL is the contract) and AQE.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FREE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "shopmarts",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the cluster's own builder settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Parquet is read at ~4x its file size; planning on the file size alone makes the static
        # planner broadcast fact scans it takes for small (AQE still broadcasts measured small sides)
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        # a checkpoint's files go when its frame does
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM only; ``local-cluster`` has executors of its own."""
    return spark.sparkContext.master.partition("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session (tests, the bench) gets its own folder when the setting is unset; on a
    cluster an unset setting is an error, because a machine-local folder is not shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; it must name a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="shopmarts-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Inside, the shuffle files of each execution of the session go when it ends, not when the driver happens to
    collect its garbage. A frame that is executed twice computes its shuffles twice."""
    before = spark.conf.get(FREE_SHUFFLES_CONF, "false")
    spark.conf.set(FREE_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES_CONF, before)


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name below the shared folder, removed when the driver process ends
    (``release_scratch``); nothing is created here."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    _SCRATCH.append((spark, path))
    return path


def _located(spark: SparkSession, path: str):
    """(file system, path in it)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own through the file system that holds it."""
    store, target = _located(spark, path)
    store.delete(target, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one file, made anew."""
    store, target = _located(spark, path)
    out = store.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_file(spark: SparkSession, path: str, data: bytes) -> bool:
    """Create one small file unless it is there; False if another writer has been first.

    Hadoop's local file system looks and creates in two steps, so there the operating system creates;
    other stores do it in one.
    """
    store, target = _located(spark, path)
    store.mkdirs(target.getParent())
    if store.getScheme() == "file":
        try:
            with open(target.toUri().getPath(), "xb") as f:
                f.write(data)
            return True
        except FileExistsError:
            return False
    try:
        out = store.create(target, False)
    except Py4JJavaError:
        if store.exists(target):
            return False
        raise
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return True


def scratch_mark() -> int:
    """How many scratch folders have been handed out: a mark for ``release_scratch``."""
    return len(_SCRATCH)


def release_scratch(since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Remove the scratch folders handed out since the mark (all by default) but those to keep; frames that
    read a removed one cannot be used afterwards."""
    kept = [(spark, path) for spark, path in _SCRATCH[since:] if path in keep]
    gone = [(spark, path) for spark, path in _SCRATCH[since:] if path not in keep]
    _SCRATCH[since:] = kept
    while gone:
        spark, path = gone.pop()
        try:
            if spark.sparkContext._jsc is not None:
                remove_path(spark, path)
        except Exception:  # noqa: BLE001  the session has gone: its checkpoint folder is the cluster's to clear
            return


atexit.register(release_scratch)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss, unlike a local one.

    The frame is persisted while it is checkpointed: an eager checkpoint runs one job to compute
    the rows and another to write them, and without the cache the second job computes them again.
    The cache is released once the files are written, unless the caller had cached the frame itself;
    lost cached blocks are recomputed from lineage.
    """
    shared_dir(df.sparkSession)
    held = df.is_cached
    cached = df if held else df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    if not held:
        cached.unpersist()
    return out
