"""Rows by their place in an order, without sorting all of them or gathering a page in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trafficloom.session import checkpointed, shared_folder

NTH, RANGE = "_nth", "range_of_keys"

#: Rows of a range, about. A task sorts a range at a time.
RANGE_ROWS = 500_000


@dataclass(frozen=True)
class RankedRows:
    """Rows dealt into ranges of their keys, a folder per range, and how many rows each holds."""

    stored: DataFrame
    keys: tuple[str, ...]
    counts: tuple[int, ...]

    @property
    def total(self) -> int:
        return sum(self.counts)

    def between(self, first: int, end: int) -> DataFrame:
        """The rows from place ``first`` to before place ``end``, with their place in ``NTH``.

        Only the ranges that hold such places are read, and each is sorted by itself.
        """
        touched, before = [], 0
        for number, count in enumerate(self.counts):
            if before < end and before + count > first:
                touched.append((number, before))
            before += count
        starts = self.stored.sparkSession.createDataFrame(touched, f"{RANGE} int, _before long")
        rows = self.stored.filter(F.col(RANGE).isin([number for number, _ in touched]))
        order = Window.partitionBy(RANGE).orderBy(*self.keys)
        within = rows.withColumn("_place", F.row_number().over(order) - 1)
        # a row per touched range, of RANGE_ROWS rows each
        numbered = within.join(F.broadcast(starts), RANGE).withColumn(NTH, F.col("_before") + F.col("_place"))
        return numbered.filter(F.col(NTH).between(first, end - 1)).drop(RANGE, "_before", "_place")


def rank_rows(rows: DataFrame, keys: list[str], range_rows: int | None = None) -> RankedRows:
    """The rows in ranges by ``keys``, which have to tell them apart.

    The rows are written once. Spark samples the keys for the borders of as many ranges as
    the rows need and deals them out; nothing is sorted. A count per range reaches the driver.
    """
    spark = rows.sparkSession
    source = checkpointed(rows)
    ranges = max(1, -(-source.count() // (range_rows or RANGE_ROWS)))
    folder = shared_folder(spark, "ranges")
    dealt = source.repartitionByRange(ranges, *keys).withColumn(RANGE, F.spark_partition_id())
    dealt.write.partitionBy(RANGE).parquet(folder)
    stored = spark.read.schema(T.StructType([*rows.schema, T.StructField(RANGE, T.IntegerType())])).parquet(folder)
    held = {r[RANGE]: r["count"] for r in stored.groupBy(RANGE).count().collect()}  # one per range
    return RankedRows(stored, tuple(keys), tuple(held.get(k, 0) for k in range(1 + max(held, default=0))))
