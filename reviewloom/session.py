"""Session helpers: settings, the shared folder, and tables written to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "reviewloom", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; anything else comes from the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        made = tempfile.mkdtemp(prefix="reviewloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_dirs[app] = made
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session's settings, with ``_`` for dots, are these meanwhile and as before afterwards."""
    named = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    try:
        for name, value in named.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cleaning(spark: SparkSession, **values: str):
    """Shuffle files of what is run meanwhile go when it is done, not when the driver collects its garbage."""
    return settings(spark, **{CLEANUP: "true"}, **values)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used where a result feeds several branches, or where a value such as a partition number must
    not be computed twice: the written table survives executor loss and is column-pruned on read.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with cleaning(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes every table that ``materialize`` and ``new_path`` have placed for this application.

    To be called once results have been written: frames that still read those tables fail after it.
    """
    remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder made by ``new_path`` once nothing reads it any more."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def discard(*written: DataFrame) -> None:
    """Removes what ``materialize`` wrote for frames that nothing reads any more."""
    for df in written:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            remove(df.sparkSession, folder)
