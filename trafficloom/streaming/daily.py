"""Keep the unified table current as day files land in the export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trafficloom.plans.jobs import Build, daily_pull
from trafficloom.plans.reports import landing_page_report
from trafficloom.schemas import EXPORT, TARGET
from trafficloom.sinks.target import create_target, is_folder


def consecutive(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Runs of neighbouring days as (first, last)."""
    runs: list[tuple[dt.date, dt.date]] = []
    for day in sorted(set(days)):
        if runs and day - runs[-1][1] == dt.timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def pull_new_days(
    spark: SparkSession,
    export_root: str,
    target: str,
    checkpoint: str,
    conversion_event: str | None = None,
    build: Build = landing_page_report,
    schema: T.StructType = TARGET,
    days_per_commit: int | None = None,
    on_bad_suffix: str = "error",
) -> None:
    """Process the files that landed since the last call, then stop.

    Only the days they belong to are recomputed, each from all of its files with
    the batch plan, and replaced in the target, which starts out empty if there is
    none. Replacing is idempotent, so a batch that is retried after a failure, the
    first one included, leaves the same result. ``days_per_commit`` cuts a long run of
    days, such as the history that a first call finds.
    """

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        # one value per day folder with new files
        touched = [row[0] for row in batch.select("event_date").distinct().collect()]
        days = [dt.datetime.strptime(day, "%Y%m%d").date() for day in touched]
        for first, last in consecutive(days):
            daily_pull(
                spark, export_root, target, (last - first).days, conversion_event, as_of=last,
                build=build, schema=schema, days_per_commit=days_per_commit, on_bad_suffix=on_bad_suffix,
            )

    if not is_folder(target) and not spark.catalog.tableExists(target):
        create_target(spark.createDataFrame([], schema), target, schema)
    landed = spark.readStream.schema(EXPORT).parquet(export_root)
    query = (
        landed.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
