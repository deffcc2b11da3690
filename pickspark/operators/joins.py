"""Joins on keys, ranges, islands and places."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.shared import cut

#: Rows that a task makes, about, where stations get the rows they share.
TASK_ROWS = 500_000


def outer_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, before: float, after: float, how: str) -> DataFrame:
    """Each left row in each bucket its range touches, joined (``how``) with the right rows there that are in the range.
    ``_nth``: which of its buckets; ``_rt``: null where the bucket has no partner."""
    size = max(before + after, 1e-6)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    l = left.withColumn("_lt", micros(left_time))  # noqa: E741
    r = right.withColumns({"_rt": micros(right_time), "_rbucket": F.floor(micros(right_time) / (size * 1e6)), **{f"_k_{k}": F.col(k) for k in keys}}).drop(*keys)
    buckets = F.sequence(F.floor((F.col("_lt") / 1e6 - before) / size), F.floor((F.col("_lt") / 1e6 + after) / size))
    l = l.select("*", F.posexplode_outer(buckets).alias("_nth", "_bucket"))  # noqa: E741
    dt = (F.col("_rt") - F.col("_lt")) / F.lit(1e6)
    on = [F.col("_bucket") == F.col("_rbucket"), dt.between(-before, after), *(F.col(k) == F.col(f"_k_{k}") for k in keys)]
    return l.join(r, on, how).withColumn("dt", dt).drop("_lt", "_bucket", "_rbucket", *(f"_k_{k}" for k in keys))


def range_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, before: float, after: float, how: str = "inner") -> DataFrame:
    """Pairs with equal ``keys`` and right - left in [-before, after] seconds, with ``dt`` (right - left); ``left``: also
    left rows without a partner.

    Time is cut into buckets as long as the range; a left row meets the buckets its range touches (two, or
    three at the rim). So it is an equi-join with a residual condition: each side is shuffled once by key and bucket,
    never a nested loop, and a busy key is spread over its buckets. A left row that finds no partner in one bucket may
    find one in another: rows are brought together once more by their columns, and of those without any the
    first bucket's stays.
    """
    pairs = outer_pairs(left, right, keys, left_time, right_time, before, after, how)
    if how == "inner":
        return pairs.drop("_nth", "_rt")
    own = Window.partitionBy(*left.columns)
    found = pairs.withColumn("_found", F.count("_rt").over(own))
    return found.where(F.col("_rt").isNotNull() | ((F.col("_found") == 0) & (F.coalesce("_nth", F.lit(0)) == 0))).drop("_nth", "_rt", "_found")


def nearest_in_space_time(origins: DataFrame, curated: DataFrame, seconds: float, km: float, near: int = 32) -> DataFrame:
    """For each origin the curated one nearest in time within both limits (smaller id on ties).

    The range in time begins with one that holds about ``near`` curated origins and widens eightfold, for the origins
    that have found none: one found in a range is the nearest. So pairs grow with the origins, not with their square;
    only origins without a curated one near by meet all of the whole range."""
    right = curated.select(*(F.col(c).alias(f"c_{c}") for c in ("origin_id", "time", "latitude", "longitude")))
    time = C.epoch_seconds(F.col("c_time"))
    span = right.agg(F.count("c_time").alias("n"), (F.max(time) - F.min(time)).alias("seconds")).first()
    width = min(seconds, max((span.seconds or 0.0) * near / max(span.n, 1) / 2, seconds / 8**6))
    rest, parts = origins, []
    while True:
        pairs = range_join(rest, right, [], "time", "c_time", width, width)
        dist = C.haversine_km(F.col("latitude"), F.col("longitude"), F.col("c_latitude"), F.col("c_longitude"))
        close = pairs.withColumn("km", dist).where(F.col("km") <= km)
        rank = F.row_number().over(Window.partitionBy("origin_id").orderBy(F.abs("dt"), "c_origin_id"))
        found = close.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
        if width >= seconds:
            return functools.reduce(DataFrame.unionByName, [*parts, found])
        parts.append(cut(found, "nearest"))
        rest = cut(rest.join(parts[-1].select(F.col("origin_id").alias("_found")), F.col("origin_id").eqNullSafe(F.col("_found")), "left_anti"), "rest")
        width = min(seconds, width * 8)


def assigned_picks(events: DataFrame, assignments: DataFrame, picks: DataFrame) -> DataFrame:
    """Event and pick columns of each assignment."""
    return assignments.join(events, "event_id").join(picks, "pick_id")


def with_run(picks: DataFrame, runs: DataFrame) -> DataFrame:
    """Run columns for each pick; runs are few, Spark sends them where their size allows."""
    return picks.join(runs, "rid")


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work without a row in ``done``."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def months_left(stations: DataFrame, days: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """``stations`` by year and month with the ``days`` (an array) of their ``keys`` that ``done`` (tid, day) does not
    have. ``days``: keys, day. A row holds a month of a station, so a station and day costs a value, not a row."""
    month = [F.year("day").alias("year"), F.month("day").alias("month")]
    every = days.groupBy(*keys, *month).agg(F.collect_set("day").alias("days"))
    have = done.groupBy("tid", *month).agg(F.collect_set("day").alias("_done"))
    both = stations.join(every, keys).join(have, ["tid", "year", "month"], "left")
    left = F.when(F.col("_done").isNull(), F.col("days")).otherwise(F.array_except("days", "_done"))
    return both.withColumn("days", left).where(F.size("days") > 0).drop("_done")


def days_of(left: DataFrame) -> DataFrame:
    """A row for each station and day of ``left`` (of ``months_left``), in as many tasks as the rows need."""
    n = left.agg(F.sum(F.size("days"))).first()[0] or 0
    return left.repartition(max(1, -(-n // TASK_ROWS)), "tid", "year", "month").withColumn("day", F.explode("days")).drop("days")


def to_stations(rows: DataFrame, left: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, day and more) for each station of ``left`` (of ``months_left``) whose days they are. Rows meet
    stations by network and month, as arrays of a month, and are repeated where the catalog is written from, so
    repeated rows are not moved. Tasks are as many as the rows that come out need."""
    at, month = ["network", *keys, "year", "month"], ["year", "month"]
    months = rows.groupBy(*keys, F.year("day").alias("year"), F.month("day").alias("month")).agg(F.collect_list(F.struct(*(c for c in rows.columns if c not in keys))).alias("_rows"))
    work = left.withColumn("network", C.network_of(F.col("tid")))
    sizes = work.groupBy(*at).agg(F.count("*").alias("_n")).join(months.select(*keys, *month, F.size("_rows").alias("_m")), [*keys, *month])
    made = sizes.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    tasks = max(1, -(-made // TASK_ROWS))
    held = months.join(work.select(*at).distinct(), [*keys, *month])
    pairs = work.repartition(tasks, *at).join(held.repartition(tasks, *at), at)
    return pairs.select(*left.columns, F.explode(F.filter("_rows", lambda x: F.array_contains("days", x["day"]))).alias("_row")).drop("days").select("*", "_row.*").drop("_row")


def of_keys(rows: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are asked for."""
    return rows.join(asked.select(*keys).distinct(), keys, "left_semi")


def covering_units(units: DataFrame, asked: DataFrame) -> DataFrame:
    """Units whose stations hold ``tid`` and whose days [start, end) hold ``day``."""
    each = units.select("shard_id", F.explode("stations").alias("tid"), "start", "end")
    return asked.join(each, "tid").where((F.col("start") <= F.col("day")) & (F.col("day") < F.col("end")))


def first_arrivals(picks: DataFrame, events: DataFrame, vp: float = 6.0, ratio: float = 1.75, stretch: float = 2.5, pad: float = 3.0, horizon: float = 120.0) -> DataFrame:
    """For each event and station the first P within ``horizon`` seconds, then the first S not later than
    ``stretch`` times the predicted S-P time plus ``pad``. ``events``: event_id, station, km, time."""
    p = range_join(events, picks.where("pha = 'P'").select(F.col("tid").alias("station"), F.col("peak").alias("p_time")), ["station"], "time", "p_time", 0.0, horizon)
    first_p = p.groupBy("event_id", "station", "km").agg(F.min("p_time").alias("p_time"))
    s = picks.where("pha = 'S'").select(F.col("tid").alias("station"), F.col("peak").alias("s_time"))
    tp, ts = C.travel_seconds(F.col("km"), vp, ratio)
    limit = (ts - tp) * stretch + pad
    pairs = range_join(first_p, s, ["station"], "p_time", "s_time", 0.0, horizon).where((F.col("dt") > 0) & (F.col("dt") <= limit))
    return first_p.join(pairs.groupBy("event_id", "station").agg(F.min("s_time").alias("s_time")), ["event_id", "station"], "left").withColumn("sp", C.epoch_seconds(F.col("s_time")) - C.epoch_seconds(F.col("p_time")))


def best_in_window(expected: DataFrame, picks: DataFrame, tol: float) -> DataFrame:
    """For each expected arrival (event_id, tid, pha, expected_at) the most confident pick within ``tol``
    seconds: ``dt``, ``conf`` and ``n_picks``; rows without a pick stay, with conf 0. Repeated rows and rows with
    nulls are arrivals like others."""
    own = expected.columns
    right = picks.select("tid", "pha", "peak", "conf", "pick_id")
    once = expected.groupBy(*own).agg(F.count("*").alias("_copies"))
    # Buckets without a pick add nothing to the counts of their rows.
    pairs = outer_pairs(once, right, ["tid", "pha"], "expected_at", "peak", tol, tol, "left")
    best = pairs.groupBy(*own, "_copies").agg(F.count("pick_id").alias("n_picks"), F.max_by(F.struct("dt", "conf"), F.when(F.col("pick_id").isNotNull(), F.struct(F.col("conf"), -F.col("pick_id")))).alias("b"))
    each = best.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
    return each.select(*own, "n_picks", F.col("b.dt").alias("dt"), F.coalesce("b.conf", F.lit(0.0)).alias("conf"))


def work_list(stations: DataFrame, first: Column, days: int) -> DataFrame:
    """A row for each station and day; the days are generated beside each station."""
    return stations.withColumn("day", F.explode(F.sequence(first, F.date_add(first, days - 1))))


def reconcile(manifest: DataFrame, coverage: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows where two tables disagree or one has none."""
    both = manifest.select(*keys, F.col(value).alias("in_manifest")).join(coverage.select(*keys, F.col(value).alias("in_coverage")), keys, "full_outer")
    return both.where(~F.col("in_manifest").eqNullSafe(F.col("in_coverage")))


def windows(picks: DataFrame, traces: DataFrame, keys: list[str], start: Column, length: Column, values: dict[str, Column] | None) -> DataFrame:
    """For each pick and trace of its keys ``start`` and ``length`` in samples, and ``values``, which are made once for
    each window of a trace, however many picks have it (none: the samples of the trace). Windows that leave the trace
    are left out; picks meet traces by window, so only pairs that come out are made. ``start`` and ``length`` may use
    ``peak``, ``t0`` and ``rate``."""
    grid = [*keys, "t0", "rate"]
    window = [*grid, "start", "length"]
    lengths = traces.groupBy(*grid).agg(F.max(F.size("samples")).alias("_most"))
    placed = picks.join(lengths, keys).withColumns({"start": start.cast("int"), "length": length.cast("int")})
    placed = placed.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("_most"))).drop("_most")
    made = traces.join(placed.select(*window).distinct(), grid).where(F.col("start") + F.col("length") <= F.size("samples"))
    return placed.join(made.withColumns(values).drop("samples") if values else made, window)


def cut_windows(picks: DataFrame, traces: DataFrame, keys: list[str], before: float, after: float, values: dict[str, Column] | None = None) -> DataFrame:
    """``windows`` of [peak - before, peak + after). The samples are not exploded."""
    start = F.round((C.epoch_seconds(F.col("peak")) - C.epoch_seconds(F.col("t0")) - before) * F.col("rate"))
    return windows(picks, traces, keys, start, F.round((before + after) * F.col("rate")), values)


def anchored_windows(picks: DataFrame, traces: DataFrame, keys: list[str], lead: float, samples: int, values: dict[str, Column] | None = None) -> DataFrame:
    """Fixed ``windows`` of ``samples`` samples that begin ``lead`` seconds before each P; without ``values`` they come
    as ``window``."""
    start = F.round((C.epoch_seconds(F.col("peak")) - C.epoch_seconds(F.col("t0")) - lead) * F.col("rate"))
    values = values or {"window": F.slice("samples", F.col("start") + 1, samples)}
    return windows(picks.where("pha = 'P'"), traces, keys, start, F.lit(samples), values).drop("length")


def routed(stations: DataFrame, routes: DataFrame, default: str = "unrouted") -> DataFrame:
    return stations.join(routes, "network_code", "left").withColumn("archive", F.coalesce("archive", F.lit(default)))


def unreachable(stations: DataFrame, routes: DataFrame, configured: list[str]) -> DataFrame:
    """Stations by network whose archive is not configured."""
    lost = routed(stations, routes).where(~F.col("archive").isin(configured))
    return lost.groupBy("network_code", "archive").agg(F.count("*").alias("n_stations"))


def align_labels(curves: DataFrame, labels: list[str], keys: list[str]) -> DataFrame:
    """Class curves of equal keys side by side; incomplete segments go."""
    return curves.groupBy(*keys).pivot("label", labels).agg(F.first("value")).dropna(subset=labels)


def in_regions(stations: DataFrame, rings: DataFrame, step: float = 1.0) -> DataFrame:
    """Stations inside each region. ``rings``: region, ring (array of lon, lat). Regions and stations meet by
    tiles of ``step`` degrees that a region's box touches, then by box, then the rays are cast."""
    xs, ys = F.transform("ring", lambda p: p["lon"]), F.transform("ring", lambda p: p["lat"])
    boxed = rings.select("region", "ring", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    tile = lambda c: F.floor(c / step)
    tiled = boxed.withColumn("_tx", F.explode(F.sequence(tile(F.col("x0")), tile(F.col("x1"))))).withColumn("_ty", F.explode(F.sequence(tile(F.col("y0")), tile(F.col("y1")))))
    near = stations.withColumns({"_tx": tile(F.col("longitude")), "_ty": tile(F.col("latitude"))}).join(tiled, ["_tx", "_ty"])
    inside = near.where(F.col("longitude").between(F.col("x0"), F.col("x1")) & F.col("latitude").between(F.col("y0"), F.col("y1")))
    return inside.where(C.in_polygon(F.col("latitude"), F.col("longitude"), F.col("ring"))).drop("ring", "x0", "x1", "y0", "y1", "_tx", "_ty")


def arrivals_of_picks(arrivals: DataFrame, picks: DataFrame, stations: DataFrame) -> DataFrame:
    """Arrivals (pick_id, phase) joined to their picks by id, of the stations asked for (id); phases as P or S."""
    named = arrivals.select("arrival_id", "pick_id", C.phase_of(F.col("phase")).alias("pha"))
    own = picks.join(stations.select(F.col("id").alias("tid")).distinct(), "tid", "left_semi")
    return named.where(F.col("pha").isin("P", "S")).join(own.drop("pha"), "pick_id")
