"""Folder listing and deletion through the Hadoop file system of a path.

This goes through the driver's JVM, so the jobs do not run over Spark Connect.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, without hidden ones; empty if there is no folder."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def empty_files(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """Folder and name of the files without a byte that a glob pattern finds; no hidden ones."""
    fs, path = _file_system(spark, pattern)
    empty = (s.getPath() for s in fs.globStatus(path) or [] if s.getLen() == 0 and s.isFile())
    found = [(p.getParent().getName(), p.getName()) for p in empty]
    return sorted(f for f in found if not f[1].startswith(("_", ".")))


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete the folder, if it is there, when the driver's JVM ends."""
    fs, folder = _file_system(spark, path)
    fs.mkdirs(folder)  # only what exists can be registered
    fs.deleteOnExit(folder)
    fs.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.mkdirs(folder)


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already. The file system sees to it that
    only one of several callers succeeds."""
    fs, file = _file_system(spark, path)
    fs.mkdirs(file.getParent())
    try:
        fs.create(file, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception) or fs.exists(file):
            return False
        raise
    return True


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    fs, folder = _file_system(spark, path)
    if not fs.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")
