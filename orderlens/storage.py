"""Small file operations through the Hadoop file system, and the shared scratch folder.

Only names and a few bytes of text pass through the driver here; table data never does.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import logging
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return bool(fs.exists(target))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder tree; False when there was nothing to delete."""
    fs, target = _open(spark, path)
    return bool(fs.delete(target, True))


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the visible entries of a folder, sorted; empty when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    entries = (status.getPath() for status in fs.listStatus(target))
    return sorted(p.toString() for p in entries if not p.getName().startswith(("_", ".")))


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since 1970."""
    fs, target = _open(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system, creating the target's parent."""
    fs, src = _open(spark, source)
    _, dst = _open(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that readers see whole or not at all."""
    hidden = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    fs, target = _open(spark, hidden)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    move(spark, hidden, path)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it is there already. Of several claimants one succeeds, where the store can tell."""
    fs, target = _open(spark, path)
    fs.mkdirs(target.getParent())
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="orderlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate tables under the folder in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster without it is an
    error, because executors could not see each other's files. All of them are deleted when the driver ends.
    """
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; results not yet read from them are lost."""
    delete(spark, _application_folder(spark))


def _application_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_scratch()
    folder = f"{root.rstrip('/')}/orderlens/{spark.sparkContext.applicationId}"
    _delete_at_exit(spark, folder)
    return folder


_FOLDERS: set[str] = set()  # that are deleted at exit


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Once for each application; its frames end with it, and so does the use of its intermediate tables.

    Also after the session has been stopped. A driver that is killed leaves the folder behind.
    """
    if folder in _FOLDERS:
        return
    _FOLDERS.add(folder)

    def remove() -> None:
        try:
            delete(spark, folder)
        except Exception as error:  # the virtual machine has ended before
            log.warning("could not delete %s: %s", folder, error)

    atexit.register(remove)


def file_path() -> Column:
    """Of each row, the path of the file that it was read from, as readers take it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def written(spark: SparkSession, df: DataFrame, folder: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table and read it back, which cuts its lineage."""
    df.write.mode("overwrite").options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for writing in here is deleted once it is written, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
