"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str | None] = {}
_WRITTEN: dict[str, list[str]] = {}


def build_session(app: str = "airq", master: str | None = None, shuffle: int | None = None, memory: str = "12g") -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        # a local session runs everything in the driver's own heap
        b = b.config("spark.driver.memory", memory)
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle))
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local path would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        named = _LOCAL_FOLDERS.setdefault(app, None) or tempfile.mkdtemp(prefix="airq-")
        _LOCAL_FOLDERS[app] = named
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; what is written there lasts as long as the process
    or the surrounding ``written_tables``."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_drop_all)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_written(spark: SparkSession, first: int = 0) -> None:
    """Delete what this process wrote to scratch paths, from the given one on."""
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(paths) > first:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        target.getFileSystem(conf).delete(target, True)


@contextmanager
def written_tables(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was written to scratch paths inside, once results are stored elsewhere."""
    first = len(_WRITTEN.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        drop_written(spark, first)


def _drop_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            drop_written(spark)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            pass


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage through a written table that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
