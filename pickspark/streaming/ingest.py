"""Continuous ingest of picks: duplicates within the watermark are dropped by key, and coverage becomes visible
only after its picks are durable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import catalog, joins
from ..sources import writers


def watermarked(stream: DataFrame, late: str = "10 minutes", keys: list[str] | None = None, time: str = "peak") -> DataFrame:
    """``stream`` with a watermark on ``time``, without repeated keys if they are given. Watermarks need a time with
    zone; the session's zone is UTC."""
    zoned = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return zoned if keys is None else zoned.dropDuplicatesWithinWatermark(keys)


def deduplicated(stream: DataFrame, late: str = "10 minutes", keys: list[str] = schemas.PICK_KEY, time: str = "peak") -> DataFrame:
    """Rows with a new key; keys are remembered as long as late data may come, so state stays bounded."""
    return watermarked(stream, late, keys, time).withColumn(time, F.col(time).cast("timestamp_ntz"))


def closed_days(picks: DataFrame, time: str = "peak") -> DataFrame:
    """Picks (``watermarked``) by station, band and day, each row once: when the watermark has passed the day's end,
    so that no pick can change it any more. What comes later than that is dropped; state holds the open days only.
    For append mode."""
    by_day = picks.groupBy("tid", "cha", F.window(time, "1 day").alias("_day")).agg(F.count("*").alias("npks"))
    return by_day.select("tid", "cha", F.year("_day.start").alias("yr"), F.dayofyear("_day.start").alias("doy"), "npks")


def coverage_of_closed_days(stream: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", keys: list[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """Write each station-day's coverage once it is closed. A batch that comes again takes the place of what it
    wrote before."""
    days = closed_days(watermarked(stream, late, schemas.PICK_KEY if keys is None else keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.write_coverage(batch, path, batch_id)

    return ingest(days, write, checkpoint, available_now)


def ingest(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def picks_then_coverage(root: str, coverage_path: str, day: str = "peak") -> Callable[[DataFrame, int], None]:
    """A sink for batches: picks first, ignoring those that are there, then coverage of the station-days that the
    batch has picks of, counted in the catalog. A batch that comes again adds no picks, and its coverage takes the
    place of what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.insert_ignoring_duplicates(batch, root, day)
        there = writers.catalog_of(batch.sparkSession, root)
        folders = writers.touched(writers.placed(batch, day))
        if there is None or not folders:
            return
        counted = catalog.coverage(writers.in_partitions(there, folders))
        writers.write_coverage(joins.of_keys(counted, catalog.coverage(batch), schemas.COVERAGE_KEY), coverage_path, batch_id)

    return write
