"""What the operators share: tables, stored intermediates, words."""

from __future__ import annotations

import functools
import re
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.session import shared_folder

#: A word is a run of characters outside space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in a batch that goes to a Python worker. Spark's default of 10,000 suits numbers;
#: rows here are whole texts, and a worker holds a batch several times over.
BATCH_ROWS = "1000"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, run after the executors' Python workers were given this package, once
    per application. Without it they find the package only if it is installed there.

    Where the session has Spark's default for the rows of a batch, it gets ``BATCH_ROWS``.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        application = spark.sparkContext.applicationId
        if application not in _shipped:
            root = Path(__file__).resolve().parents[2]
            archive = shutil.make_archive(f"{tempfile.mkdtemp()}/trafficloom", "zip", root, "trafficloom")
            spark.sparkContext.addPyFile(archive)
            _shipped.add(application)
        if spark.conf.get(BATCH_SETTING) == "10000":
            spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one, deleted when the driver's JVM ends.

    Results are lazy and may be read after the query function has returned, so
    nothing earlier can tell that the folder is no longer needed.
    """
    path = shared_folder(spark, purpose)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return path


def file_system(uri: str):
    """The ``pyarrow`` file system of a path, and the path within it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: computed
    once, whole after the loss of executors, and with a short lineage."""
    spark = frame.sparkSession
    path = f"{new_folder(spark, purpose)}/rows"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
