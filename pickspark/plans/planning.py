"""Work planning: stations and days into units with content-derived ids."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


#: Stations that one task numbers, about, and ranges at most (their borders are literals of the plan).
RANGE_ROWS, MOST_RANGES = 50_000, 1000


def grouped_stations(stations: DataFrame, size: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``station_group``: sorted ids in blocks of ``size``. Ids are numbered within ranges, to which the counts
    of the ranges before are added. Borders come from a sample and stay fixed, so a range is the same wherever
    the stations are read again. Stations of one id are in order of their other columns, so a plan that is computed
    again is the same plan."""
    ranges = min(MOST_RANGES, -(-stations.count() // range_rows))
    borders = []
    if ranges > 1:
        ids = sorted(x.id for x in stations.select("id").dropna().orderBy(F.xxhash64("id"), "id").limit(100 * ranges).collect())
        borders = sorted({ids[len(ids) * i // ranges] for i in range(1, ranges)} if ids else ())
    place = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= F.col("id"))) if borders else F.lit(0)
    ranged = stations.withColumn("_range", place)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")  # a row a range
    others = [c for c in stations.columns if c != "id"]
    at = F.row_number().over(Window.partitionBy("_range").orderBy("id", *others)) - 1
    numbered = ranged.withColumn("_at", at).join(F.broadcast(counts.select("_range", before.alias("_before"))), "_range")
    return numbered.withColumn("station_group", F.floor((F.col("_before") + F.col("_at")) / size)).drop("_range", "_at", "_before")


def day_groups(spark, start: datetime.date, end: datetime.date, size: int) -> DataFrame:
    """Days [start, end) in blocks: day_group, d0, d1 (exclusive)."""
    n = -(-(end - start).days // size)
    i = F.col("id").cast("int")
    first = F.date_add(F.lit(start), i * size)
    return spark.range(n).select(F.col("id").alias("day_group"), first.alias("d0"), F.least(F.date_add(first, size), F.lit(end)).alias("d1"))


def live_days(stations: DataFrame, start: datetime.date, end: datetime.date, size: int) -> DataFrame:
    """Each station in each block of days that its operating window meets, with the days that overlap. Unknown
    windows meet all. The blocks are generated beside each station, so nothing is joined."""
    n = -(-(end - start).days // size)
    block = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    s, e = C.parse_year_day(F.col("start_date")), C.parse_year_day(F.col("end_date"))
    first = F.date_add(F.lit(start), F.col("day_group") * size)
    rows = stations.withColumn("day_group", block).withColumns({"d0": first, "d1": F.least(F.date_add(first, size), F.lit(end))})
    return rows.withColumn("days", C.overlap_days(s, e, F.col("d0"), F.col("d1"))).where("days > 0")


def plan(stations: DataFrame, start: datetime.date, end: datetime.date, station_group: int = 40, day_group: int = 20) -> DataFrame:
    """Units: shard_id, stations, start, end (exclusive, YYYY.DDD), n_station_days."""
    live = live_days(grouped_stations(stations, station_group), start, end, day_group)
    units = live.groupBy("station_group", "day_group", "d0", "d1").agg(F.array_sort(F.collect_list("id")).alias("stations"), F.sum("days").cast("long").alias("n_station_days"))
    return units.select(C.unit_id(F.col("stations"), F.col("d0"), F.col("d1")).alias("shard_id"), "stations", C.year_day(F.col("d0")).alias("start"), C.year_day(F.col("d1")).alias("end"), "n_station_days")


def cost(units: DataFrame, seconds_a_day: float, cores: int, dollars_an_hour: float) -> DataFrame:
    """Station-days, core hours and cost of a plan."""
    total = units.agg(F.count("*").alias("units"), F.sum("n_station_days").alias("station_days"))
    hours = F.col("station_days") * seconds_a_day / 3600
    return total.withColumn("vcpu_hours", hours * cores).withColumn("dollars", hours * dollars_an_hour)


def selected_bands(stations: DataFrame) -> DataFrame:
    """Add ``band``: the best of a station's channels by the fixed priority, null if none is usable."""
    return stations.withColumn("band", C.best_band(F.split("channels", ",")))


def first_complete_band(have: DataFrame, priority: list[str] = C.BAND_PRIORITY) -> DataFrame:
    """The best band that has complete data. ``have``: tid, cha, complete."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("cha"))
    return have.where(F.col("complete") & (rank > 0)).groupBy("tid").agg(F.min_by("cha", rank).alias("band"))


def station_days(stations: DataFrame, start: datetime.date, end: datetime.date, by: list[str]) -> DataFrame:
    """Stations, station-days of [start, end) by their operating windows, and days a station, by campaign, region or both,
    with totals (null) of each. Stations without a day in the window count as stations."""
    days = C.overlap_days(C.parse_year_day(F.col("start_date")), C.parse_year_day(F.col("end_date")), F.lit(start), F.lit(end))
    found = stations.withColumn("_days", days).rollup(*by).agg(F.countDistinct("id").alias("stations"), F.sum("_days").alias("station_days"))
    return found.withColumn("days_a_station", C.ratio(F.col("station_days"), F.col("stations")))
