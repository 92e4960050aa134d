"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of written steps, by the frame that reads them, and the steps of every ``settle`` that is under way, the innermost last.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_under_way: list[list[str]] = []
#: Whether Spark deletes a query's shuffle files as soon as it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack capture per column call
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Unset on a master that is one process (``local``, ``local[n]``), where every folder is shared: a fresh
    folder under /tmp. Unset anywhere else, ``local-cluster`` included: an error, because a
    driver-local folder would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _own_shuffles_only(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within go when each ends; the session's setting is as before afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (an action).

    Lost executors cost nothing before this point, nothing above it runs twice, and
    the file size is known, so Spark broadcasts the result only when it really is small. What was shuffled
    for the table is deleted with the end of the write, since only the table is read from then on.
    """
    folder = run_folder(df.sparkSession, "step")
    if _under_way:
        _under_way[-1].append(folder)
    with _own_shuffles_only(df.sparkSession):
        df.write.parquet(folder)
    step = df.sparkSession.read.schema(df.schema).parquet(folder)
    _folders[step] = folder
    return step


def discard(step: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote for ``step``, which nothing reads from here on."""
    _delete(step.sparkSession, _folders.pop(step))


def settle(make: Callable[..., DataFrame], *given) -> DataFrame:
    """``make(*given)`` as a written table; every other step that was written meanwhile is deleted, also when ``make`` fails.

    Inside another ``settle`` the table itself is one of that one's steps. A frame that reads steps of ``make`` may leave it as its result only.
    """
    spark = SparkSession.active()
    _under_way.append([])
    try:
        done = cut_lineage(make(*given))
        _under_way[-1].remove(_folders[done])
    finally:
        for folder in _under_way.pop():
            _delete(spark, folder)
    if _under_way:
        _under_way[-1].append(_folders[done])
    return done


def _delete(spark: SparkSession, folder: str) -> None:
    """Through the file system that wrote it; a folder that is gone already is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
