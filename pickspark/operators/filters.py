"""Selections over stations, picks and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def in_extent(df: DataFrame, extent: tuple[float, float, float, float], closed: str = "both", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside (min lat, max lat, min lon, max lon); ``closed``: 'both' or 'neither'."""
    lat0, lat1, lon0, lon1 = extent
    if closed == "both":
        return df.where(F.col(lat).between(lat0, lat1) & F.col(lon).between(lon0, lon1))
    return df.where((F.col(lat) > lat0) & (F.col(lat) < lat1) & (F.col(lon) > lon0) & (F.col(lon) < lon1))


def in_networks(df: DataFrame, networks: str, column: str = "network_code") -> DataFrame:
    """``networks``: a comma list, blanks around names ignored; empty keeps all."""
    names = [n.strip() for n in networks.split(",") if n.strip()]
    return df.where(F.col(column).isin(names)) if names else df


def restrict_ids(df: DataFrame, ids: DataFrame, column: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows whose id is asked for, and the ids asked for that are not there."""
    asked = ids.select(column).distinct()
    return df.join(asked, column, "left_semi"), asked.join(df, column, "left_anti")


def operating(stations: DataFrame, start: Column, end: Column) -> DataFrame:
    """Stations whose operating window meets the days [start, end); unknown bounds are open."""
    return stations.where(C.windows_overlap(C.parse_year_day(F.col("start_date")), C.parse_year_day(F.col("end_date")), start, end))


def picks_between(picks: DataFrame, t0: Column, t1: Column, ids: DataFrame | None = None, closed: str = "left", time: str = "peak") -> DataFrame:
    """Picks in [t0, t1), or (t0, t1) with ``closed='neither'``, of the stations ``ids`` (column id)."""
    after = F.col(time) > t0 if closed == "neither" else F.col(time) >= t0
    out = picks.where(after & (F.col(time) < t1))
    return out if ids is None else out.join(ids.select(F.col("id").alias("tid")).distinct(), "tid", "left_semi")


def above_threshold(picks: DataFrame, p: float, s: float, conf: str = "conf") -> DataFrame:
    return picks.where(F.col(conf) >= F.when(F.col("pha") == "P", F.lit(p)).otherwise(F.lit(s)))


def guard_gaps(segments: DataFrame, most: int = 150, keys: tuple[str, ...] = ("tid", "cha", "day")) -> tuple[DataFrame, DataFrame]:
    """Segments of station-days with at most ``most`` of them, and the station-days that had more (they keep a
    coverage row with no picks)."""
    broken = segments.groupBy(*keys).agg(F.count("*").alias("n_segments")).where(F.col("n_segments") > most)
    return segments.join(broken, list(keys), "left_anti"), broken.withColumn("npks", F.lit(0).cast("long"))


def complete_components(traces: DataFrame, keys: list[str], required: tuple[str, ...] = ("Z", "N", "E"), column: str = "component") -> DataFrame:
    """Groups that have all required components."""
    have = traces.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias("components"))
    return have.where(F.size(F.array_except(F.array(*map(F.lit, required)), "components")) == 0)


def complete_windows(traces: DataFrame, seconds: float, share: float, samples: str = "samples", rate: str = "rate") -> DataFrame:
    return traces.where(F.size(samples) >= F.lit(share * seconds) * F.col(rate))


def analyst_only(arrivals: DataFrame, column: str = "evaluation_mode") -> DataFrame:
    """Without automatic picks; those without a mode stay."""
    return arrivals.where(F.coalesce(F.col(column), F.lit("manual")) != "automatic")


def at_least(counts: DataFrame, column: str, least: int) -> DataFrame:
    return counts.where(F.col(column) >= least)


def seismic_components(channels: DataFrame, column: str = "channel") -> DataFrame:
    """Rows of components Z, N, E, 1, 2 (hydrophones go), with 1 and 2 renamed."""
    return channels.where(F.col(column).rlike("[ZNE12]$")).withColumn("component", C.component_of(F.col(column)))


def shape_picks(picks: DataFrame, rid: Column) -> DataFrame:
    """Stored form: float32 values, millisecond times, run id."""
    milli = lambda c: F.date_trunc("MILLISECOND", c).cast("timestamp_ntz")
    return picks.select(
        "tid", "cha", "pha", *(milli(F.col(c)).alias(c) for c in ("start_ts", "peak", "end_ts")), *(F.col(c).cast("float").alias(c) for c in ("conf", "amp", "amp_raw")), rid.alias("rid")
    )


def association_input(picks: DataFrame) -> DataFrame:
    return picks.select(F.col("tid").alias("station"), F.col("pha").alias("phase"), C.epoch_seconds(F.col("peak")).alias("time"), "conf")


def station_history(picks: DataFrame, tid: str) -> DataFrame:
    return picks.where(F.col("tid") == tid).orderBy("peak", "pha", "cha")


def with_notes(windows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Add ``note``: the first reason whose condition holds, null for good rows; no row is dropped."""
    note = F.lit(None).cast("string")
    for text, when in reversed(reasons.items()):
        note = F.when(when, F.lit(text)).otherwise(note)
    return windows.withColumn("note", note)


def near(events: DataFrame, lat: float, lon: float, km: float, mag: tuple[float, float], most: int, per: str | None = None) -> DataFrame:
    """Events within ``km`` and the magnitudes, the largest ``most`` (of each ``per``)."""
    from pyspark.sql import Window

    dist = C.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    found = events.withColumn("km", dist).where((F.col("km") <= km) & F.col("mag").between(*mag))
    if per is None:
        return found.orderBy(F.desc("mag"), "origin_id").limit(most)
    rank = F.row_number().over(Window.partitionBy(per).orderBy(F.desc("mag"), "origin_id"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
