"""Written tables in the folder that all executors share.

Lineage is cut by writing a table and reading it again, never by ``localCheckpoint``: the files outlive a lost
executor. The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a local session gets a temporary
folder; a cluster session gets an error, since its executors would not see a folder of the driver's machine.

All tables of one process lie in one folder of their own, which is deleted when the process ends, or by :func:`clean`; what
is made within :func:`scope` is deleted when the scope ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_RUN = uuid.uuid4().hex
_MADE: list[str] = []
_CLEANED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="lodestrom-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def _run_dir(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark)}/lodestrom/{_RUN}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        atexit.register(_delete, jvm, conf, folder)
    return folder


def _delete(jvm: object, conf: object, path: str) -> None:
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    except Exception:  # the JVM may be gone when the process ends
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, so that it works wherever the folder lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables made within; results that are still needed must have been written or collected by then."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            remove(spark, path)
        del _MADE[before:]


def clean(spark: SparkSession) -> None:
    """Delete every table that this process made in the shared folder."""
    for path in _MADE:
        remove(spark, path)
    _MADE.clear()
