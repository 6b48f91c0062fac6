"""Where intermediate results go: the folder the cluster names, shared by all nodes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The paths given inside the innermost ``cleared``.
_given: ContextVar[list[str] | None] = ContextVar("given", default=None)

SETTING = "spark.checkpoint.dir"

# Codec of tables that are read within the job that writes them.
STAGE_CODEC = "zstd"

# Has Spark delete the shuffle files of a query at its end, else they stay until the driver
# happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or else the one checkpoints go to.

    A local session may have neither and gets a new one, which goes with the process.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all nodes can reach")
    own = tempfile.mkdtemp(prefix="wordloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def use_shared_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    given = _given.get()
    if given is not None:
        given.append(path)
    return path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """All that goes to paths of ``new_path`` inside is deleted at the end, also after a failure.

    For jobs that write their results elsewhere; a DataFrame that is read later
    must not leave this.
    """
    token = _given.set([])
    try:
        yield
    finally:
        paths = _given.get() or []
        _given.reset(token)
        for path in paths:
            remove(spark, path)


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """``df`` computed once and cut from what made it, in the shared folder.

    Inside ``cleared`` it is a table that goes at the end. Elsewhere it is a
    checkpoint, which Spark deletes once nothing refers to it, where
    spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    spark = df.sparkSession
    if _given.get() is None:
        use_shared_checkpoints(spark)
        return df.checkpoint()
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str = "kept") -> DataFrame:
    """What ``make`` gives, as a table in the shared folder. All that ``make`` itself keeps there
    goes as soon as the table is written. For use inside ``cleared``."""
    path = new_path(spark, name)
    with cleared(spark), shuffles_freed(spark):
        df = make()
        df.write.parquet(path, compression=STAGE_CODEC)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside are deleted as soon as it is written."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that ``new_path`` gave, on whatever file system it is."""
    if not path.startswith(shared_folder(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
