"""Aggregations over the pick catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def partition_summary(picks: DataFrame) -> DataFrame:
    """Picks and mean confidence by network, year, month and phase."""
    at = F.col("peak")
    return picks.groupBy("network", F.year(at).alias("year"), F.month(at).alias("month"), "pha").agg(F.count("*").alias("picks"), F.avg("conf").alias("mean_conf"))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def station_years(picks: DataFrame, year: int | None = None) -> DataFrame:
    rows = picks.withColumn("year", F.year("peak"))
    rows = rows if year is None else rows.where(F.col("year") == year)
    return rows.groupBy("tid", "year").agg(F.count("*").alias("picks"))


def phase_counts(picks: DataFrame) -> DataFrame:
    return picks.groupBy("pha").agg(F.count("*").alias("picks"), F.countDistinct("network").alias("networks"))


def distribution(picks: DataFrame, columns: list[str], accuracy: int = 100_000) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of each column; NaN and null are skipped.

    Quartiles take passes of mergeable aggregates: a sketch brackets each of them within ``1 / accuracy`` of
    the rows, the rows below a bracket are counted, and only values inside the brackets are put in order."""
    quarters = (0.25, 0.5, 0.75)
    v = {c: C.nan_to_null(F.col(c).cast("double")) for c in columns}
    rows = picks.agg(*(F.count(v[c]).alias(c) for c in columns)).first()
    slack = {c: 4.0 / accuracy + 2.0 / max(rows[c], 1) for c in columns}
    at = {c: F.array(*[F.lit(min(max(q + d, 0.0), 1.0)) for q in quarters for d in (-slack[c], slack[c])]) for c in columns}
    around = picks.agg(*(F.percentile_approx(v[c], at[c], accuracy).alias(c) for c in columns)).first()
    inside = {(c, i): (around[c][2 * i], around[c][2 * i + 1]) for c in columns for i in range(3) if around[c]}
    below = picks.agg(F.count("*"), *(F.count_if(v[c] < lo).alias(f"below_{c}_{i}") for (c, i), (lo, _) in inside.items()), *(F.count_if(v[c].between(lo, hi)).alias(f"in_{c}_{i}") for (c, i), (lo, hi) in inside.items())).first()

    def quartile(c: str, i: int) -> Column:
        if (c, i) not in inside:
            return F.lit(None).cast("double")
        lo, hi = inside[c, i]
        rank, held = quarters[i] * (rows[c] - 1) - below[f"below_{c}_{i}"], below[f"in_{c}_{i}"]
        return F.percentile(F.when(v[c].between(lo, hi), v[c]), F.lit(min(max(rank / (held - 1), 0.0), 1.0) if held > 1 else 0.0))

    names = ("n", "mean", "std", "low", "q1", "median", "q3", "high")
    values = {c: (F.count(v[c]), F.avg(v[c]), F.stddev(v[c]), F.min(v[c]), *(quartile(c, i) for i in range(3)), F.max(v[c])) for c in columns}
    one = picks.agg(*(x.alias(f"{c}_{n}") for c in columns for n, x in zip(names, values[c])))
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *(F.col(f"{c}_{n}").alias(n) for n in names)) for c in columns])).alias("x")).select("x.*")


def amplitude_completeness(picks: DataFrame) -> DataFrame:
    """By network: picks, those with an amplitude, null and NaN apart, confidence bounds, stations."""
    return picks.groupBy("network").agg(
        F.count("*").alias("picks"),
        F.count_if(F.col("amp").isNotNull() & ~F.isnan("amp")).alias("with_amp"),
        F.count_if(F.col("amp").isNull()).alias("null_amp"),
        F.count_if(F.isnan("amp")).alias("nan_amp"),
        F.min("conf").alias("min_conf"),
        F.max("conf").alias("max_conf"),
        F.countDistinct("tid").alias("stations"),
    )


def coverage(picks: DataFrame, work: DataFrame | None = None, **counted: Column) -> DataFrame:
    """Picks by station, band and day; with a work list (tid, cha, day) days without picks have a row too. ``counted``:
    conditions whose picks are counted besides."""
    counts = [F.count("*").alias("npks"), *(F.count_if(c).alias(n) for n, c in counted.items())]
    found = picks.groupBy("tid", "cha", F.year("peak").alias("yr"), F.dayofyear("peak").alias("doy")).agg(*counts)
    if work is None:
        return found
    days = work.select("tid", "cha", F.year("day").alias("yr"), F.dayofyear("day").alias("doy")).distinct()
    return days.join(found, ["tid", "cha", "yr", "doy"], "left").fillna(0, ["npks", *counted])


def coverage_by_year(cover: DataFrame) -> DataFrame:
    return cover.groupBy("yr").agg(F.count("*").alias("station_days"), F.sum("npks").alias("picks"))


def manifest_totals(manifests: DataFrame) -> DataFrame:
    """By job: files, rows and coverage rows."""
    files = manifests.select("job_id", F.explode_outer("files").alias("f")).groupBy("job_id").agg(F.count("f").alias("n_files"), F.sum("f.rows").alias("n_rows"))
    return manifests.select("job_id", F.size("records").alias("n_records")).join(files, "job_id").orderBy(F.desc("n_rows"), "job_id")


def weight_summary(picks: DataFrame) -> DataFrame:
    p, s = F.col("pha") == "P", F.col("pha") == "S"
    return picks.groupBy("weight").agg(
        F.count("*").alias("picks"), F.count_if(p).alias("p_picks"), F.count_if(s).alias("s_picks"), F.avg(F.when(p, F.col("conf"))).alias("p_conf"), F.avg(F.when(s, F.col("conf"))).alias("s_conf")
    )


def origin_gaps(origins: DataFrame, close: float, time: str = "time") -> DataFrame:
    """By day: gaps in seconds between consecutive origins."""
    by = Window.partitionBy("day").orderBy(time, "origin_id")
    t = C.epoch_seconds(F.col(time))
    gaps = origins.withColumn("day", F.to_date(time)).withColumn("gap", t - F.lag(t).over(by)).where("gap IS NOT NULL")
    return gaps.groupBy("day").agg(F.count("*").alias("n"), F.percentile("gap", F.lit(0.5)).alias("median_gap"), F.min("gap").alias("min_gap"), F.count_if(F.col("gap") < close).alias("n_close"))


def offset_spread(offsets: DataFrame) -> DataFrame:
    """Spread of offsets within events and between their means, and the ratio; and correlation with distance.
    ``offsets``: event_id, dt, km."""
    events = offsets.groupBy("event_id").agg(F.stddev("dt").alias("s"), F.avg("dt").alias("m"))
    spread = events.agg(F.avg("s").alias("within_event"), F.stddev("m").alias("between_events"))
    return spread.withColumn("spread_ratio", C.ratio(F.col("between_events"), F.col("within_event"))).join(offsets.agg(F.corr("dt", "km").alias("corr_km")))


def offshore_networks(stations: DataFrame, depth: float = 50.0, least: int = 3, share: float = 0.5) -> DataFrame:
    below = F.col("elevation") < -depth
    found = stations.groupBy("network_code").agg(F.count("*").alias("stations"), F.count_if(below).alias("deep"), F.avg((F.col("elevation") < 0).cast("double")).alias("submarine"))
    return found.where((F.col("deep") >= least) & (F.col("submarine") >= share))


def stage_times(log: DataFrame) -> DataFrame:
    """Seconds, calls and share of the whole by stage. ``log``: stage, seconds."""
    stages = log.groupBy("stage").agg(F.sum("seconds").alias("seconds"), F.count("*").alias("calls"))
    return stages.withColumn("share", C.ratio(F.col("seconds"), F.sum("seconds").over(Window.partitionBy(F.lit(1))))).orderBy(F.desc("seconds"), "stage")


def stage_report(log: DataFrame, wall: float) -> DataFrame:
    """Where the ``wall`` seconds of a run went. ``log``: stage, seconds, and what a call has worked on: units (or null)
    and unit (name). By stage seconds, share of the wall clock, calls, seconds a call, units and their rate (MB/s of
    bytes, else ms a unit); then rows of the accounted, the whole and the unaccounted time."""
    stages = log.groupBy("stage").agg(F.sum("seconds").alias("seconds"), F.count("*").alias("calls"), F.sum("units").alias("units"), F.max("unit").alias("unit"))
    rate = F.when(F.col("unit") == "bytes", C.ratio(F.col("units"), F.col("seconds")) / 1e6).otherwise(C.ratio(F.col("seconds") * 1000, F.col("units")))
    each = stages.withColumns({"per_call": C.ratio(F.col("seconds"), F.col("calls")), "rate": F.when(F.col("unit").isNotNull(), rate)})
    total = log.agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("s"))
    lines = F.array(F.struct(F.lit("accounted").alias("stage"), F.col("s").alias("seconds")), F.struct(F.lit("wall clock").alias("stage"), F.lit(float(wall)).alias("seconds")), F.struct(F.lit("unaccounted").alias("stage"), (F.lit(float(wall)) - F.col("s")).alias("seconds")))
    out = each.unionByName(total.select(F.explode(lines).alias("x")).select("x.*"), allowMissingColumns=True)
    return out.withColumn("share", C.ratio(F.col("seconds"), F.lit(float(wall))))


def insert_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to insert so that the target has each key once."""
    return rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def progress(units: DataFrame, claims: DataFrame, complete: DataFrame, now: Column, lease_hours: float) -> DataFrame:
    """Totals of a campaign, and claims that are stale: older than the lease and not complete."""
    done = complete.select("shard_id").distinct().withColumn("done", F.lit(True))
    held = claims.groupBy("shard_id").agg(F.max("claimed").alias("claimed"))
    state = units.select("shard_id").join(done, "shard_id", "left").join(held, "shard_id", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    age = (C.epoch_seconds(now) - C.epoch_seconds(F.col("claimed"))) / 3600
    return state.agg(
        F.count("*").alias("total"),
        F.count_if("done").alias("complete"),
        F.count_if(~F.col("done") & F.col("claimed").isNotNull()).alias("in_flight"),
        F.count_if(~F.col("done")).alias("remaining"),
        F.count_if(~F.col("done") & (age >= lease_hours)).alias("stale"),
    )
