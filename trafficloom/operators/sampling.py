"""Drawing report rows by a digest, and tables laid out so that a draw skips files."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom.schemas import LANDING_DIMENSIONS, TARGET

# Hexadecimal digits of a digest that a double holds exactly.
SAMPLE_DIGITS = 13
DRAWN = "drawn"


def draw(dimensions: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) from a digest of the row's dimensions, so that the same rows are
    drawn however the table is laid out and whichever engine draws them."""
    parts = [F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dimensions]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, SAMPLE_DIGITS), 16, 10).cast("bigint") / F.lit(float(16**SAMPLE_DIGITS))


@dataclass(frozen=True)
class DrawnLayout:
    """A table's days cut into ``buckets`` by the draw of a seed, in the column ``DRAWN``.

    A bucket holds a run of draws, so a fraction of the rows lies in the first buckets.
    """

    seed: int = 0
    buckets: int = 16
    dimensions: tuple[str, ...] = tuple(LANDING_DIMENSIONS)

    def write(self, table: DataFrame, folder: str, mode: str = "errorifexists") -> None:
        bucket = F.floor(draw(self.dimensions, self.seed) * self.buckets).cast("int")
        laid = table.withColumn(DRAWN, bucket).hint("rebalance", "date", DRAWN)
        laid.write.mode(mode).partitionBy("date", DRAWN).parquet(folder)

    def read(self, spark: SparkSession, folder: str, schema: T.StructType = TARGET) -> DataFrame:
        whole = T.StructType([*schema, T.StructField(DRAWN, T.IntegerType())])
        return spark.read.schema(whole).parquet(folder).select(*whole.fieldNames())  # partition columns are read last

    def may_hold(self, fraction: float) -> Column:
        """The buckets that rows of the fraction lie in."""
        return F.col(DRAWN) < math.ceil(fraction * self.buckets)
