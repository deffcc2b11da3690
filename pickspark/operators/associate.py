"""Phase association by a coarse-to-fine search of a space-time grid.

A pick votes for an origin time at each grid cell within reach of its station; picks whose origin times fall together at
a cell make an event. Cells are searched in blocks: for a block of cells a pick's origin time lies in an interval, from
the block's nearest and farthest point; the picks whose intervals meet a bin of time bound the votes that any cell of
the block can gather in it from above. Only blocks and bins whose bound reaches the thresholds are divided, into four
blocks and two bins each, down to single cells. The events are those of the full grid.

It has the inputs, thresholds and outputs of a travel-time associator, but is a different algorithm: locations
are cell centres.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.shared import cut

KM_PER_DEGREE = math.pi * C.EARTH_KM / 180
#: Widens intervals by more than rounding can move an origin time, in seconds.
SLACK = 1e-3
#: Picks for each task of a step that sorts their rows. A pick has a row for each cell and bin within reach.
TASK_PICKS = 5_000
#: A block and bin of the search, and the coarsest one around it. All rows that meet in a cell and bin have the same
#: coarsest one, so they are dealt by it once, before they are divided, and stay in their task to the candidates.
PLACE, TOP = ["by", "bx", "bin"], ["top_y", "top_x", "top_bin"]
#: Places of stations that are sent to every task, at most.
MOST_PLACES = 1_000_000


@dataclass(frozen=True)
class Search:
    """The grid (south, north, west, east in degrees), times and thresholds of a search."""

    extent: tuple[float, float, float, float]
    step: float = 0.1
    depths: tuple[float, ...] = (0.0, 10.0, 25.0)
    tolerance: float = 1.5
    cutoff_km: float = 150.0
    vp: float = 6.0
    ratio: float = 1.75
    n_picks: int = 8
    n_p: int = 3
    n_s: int = 3
    n_both: int = 3

    @property
    def shape(self) -> tuple[int, int]:
        lat0, lat1, lon0, lon1 = self.extent
        return int((lat1 - lat0) / self.step) + 1, int((lon1 - lon0) / self.step) + 1

    @property
    def levels(self) -> int:
        """The coarsest blocks are about as wide as the cutoff, and not wider than the grid needs."""
        wide = math.log2(max(self.cutoff_km / KM_PER_DEGREE / self.step, 1))
        return max(0, min(math.ceil(wide), math.ceil(math.log2(max(self.shape)))))

    def enough(self) -> Column:
        return (F.col("n_p") + F.col("n_s") >= self.n_picks) & (F.col("n_p") >= self.n_p) & (F.col("n_s") >= self.n_s) & (F.col("n_both") >= self.n_both)


def grid(spark, extent: tuple[float, float, float, float], step: float, depths: list[float]) -> DataFrame:
    """Cells over the extent: cell, lat, lon, depth."""
    ny, nx = Search(extent, step).shape
    cells = spark.range(ny * nx * len(depths)).withColumnRenamed("id", "cell")
    k = F.col("cell")
    depth = F.element_at(F.array(*map(F.lit, depths)), (F.pmod(k, F.lit(len(depths))) + 1).cast("int"))
    flat = F.floor(k / len(depths))
    return cells.select("cell", (F.floor(flat / nx) * step + extent[0]).alias("lat"), (F.pmod(flat, F.lit(nx)) * step + extent[2]).alias("lon"), depth.alias("depth"))


def travel_table(stations: DataFrame, cells: DataFrame, cutoff_km: float, vp: float, ratio: float) -> DataFrame:
    """Seconds from each cell to each station within the cutoff. Stations and cells meet in tiles as wide as the
    cutoff, in latitude and (at the latitude farthest from the equator that counts) in longitude, so no station
    is compared with more than the cells around it."""
    width = cutoff_km / 111.0
    far = F.least((F.abs(F.col("band") + 0.5) + 1.5) * width, F.lit(89.9))
    tiles = F.greatest(F.floor(F.cos(F.radians(far)) * 360 / width), F.lit(1))
    tile = lambda lon: F.floor((F.col(lon) + 180) / 360 * F.col("tiles"))
    s = stations.select(F.col("id").alias("tid"), "latitude", "longitude").withColumn("band", F.explode(F.array(*[F.floor(F.col("latitude") / width) + d for d in (-1, 0, 1)]))).withColumn("tiles", tiles)
    s = s.withColumn("tile", F.explode(F.array_distinct(F.array(*[F.pmod(tile("longitude") + d, F.col("tiles")) for d in (-1, 0, 1)])))).drop("tiles")
    c = cells.withColumn("band", F.floor(F.col("lat") / width)).withColumn("tiles", tiles).withColumn("tile", F.pmod(tile("lon"), F.col("tiles"))).drop("tiles")
    km = C.haversine_km(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))
    near = s.join(c, ["band", "tile"]).withColumn("km", km).where(F.col("km") <= cutoff_km)
    tp, ts = C.travel_seconds(C.hypocentral_km(F.col("km"), F.col("depth")), vp, ratio)
    return near.select("tid", "cell", "lat", "lon", "depth", F.explode(F.array(F.struct(F.lit("P").alias("pha"), tp.alias("tt")), F.struct(F.lit("S").alias("pha"), ts.alias("tt")))).alias("x")).select("tid", "cell", "lat", "lon", "depth", "x.pha", "x.tt")


# The search


def slowness(s: Search) -> Column:
    return F.when(F.col("pha") == "P", F.lit(1 / s.vp)).otherwise(F.lit(s.ratio / s.vp))


def reach(s: Search, level: int) -> tuple[Column, Column]:
    """Of a station and a block ``by``, ``bx`` the least and (within the cutoff) the largest distance to its cells."""
    size, half = 1 << level, ((1 << level) - 1) / 2
    lat, lon = (F.col(b) * size * s.step + (o + half * s.step) for b, o in (("by", s.extent[0]), ("bx", s.extent[2])))
    km = C.haversine_km(F.col("latitude"), F.col("longitude"), lat, lon)
    # From the middle along the parallel and the meridian to any cell of the block.
    wide = half * s.step * KM_PER_DEGREE * (1 + F.cos(F.radians(lat)))
    return F.greatest(km - wide, F.lit(0.0)), F.least(km + wide, F.lit(s.cutoff_km))


def begins(rows: DataFrame, s: Search, level: int, near: Column, far: Column) -> DataFrame:
    """Rows (of a pick) with the first and last bin of this level in which an event between ``near`` and ``far`` may
    begin: the pick's earliest and latest origin time there."""
    first = F.col("t") - C.hypocentral_km(far, F.lit(max(s.depths))) * slowness(s) - 2 * s.tolerance - SLACK
    last = F.col("t") - C.hypocentral_km(near, F.lit(min(s.depths))) * slowness(s) + SLACK
    width = 2 * s.tolerance * (1 << level)
    return rows.withColumns({"first": F.floor(first / width), "last": F.floor(last / width)})


def reached(rows: DataFrame, s: Search, level: int) -> DataFrame:
    """Rows (of a pick and a block ``by``, ``bx``) within the cutoff, with the first and last bin (``begins``)."""
    near, far = reach(s, level)
    return begins(rows.where(near <= s.cutoff_km + SLACK), s, level, near, far)


def blocks(stations: DataFrame, s: Search) -> DataFrame:
    """Stations with the coarsest blocks around them."""
    size = (1 << s.levels) * s.step
    margin = s.cutoff_km / KM_PER_DEGREE
    places = stations.select(F.col("id").alias("tid"), "latitude", "longitude")
    lat, lon = F.col("latitude"), F.col("longitude")
    # Near a pole the margin in longitude is the whole circle.
    wide = F.least(F.lit(margin) / F.greatest(F.cos(F.radians(F.least(F.abs(lat) + margin, F.lit(89.9)))), F.lit(1e-3)), F.lit(360.0))
    for name, c, low, m, n in (("by", lat, s.extent[0], F.lit(margin), s.shape[0]), ("bx", lon, s.extent[2], wide, s.shape[1])):
        most = -(-n // (1 << s.levels)) - 1
        begin, end = F.greatest(F.floor((c - m - low) / size) - 1, F.lit(0)), F.least(F.floor((c + m - low) / size) + 1, F.lit(most))
        places = places.withColumns({"_b": begin, "_e": end}).where("_b <= _e").withColumn(name, F.explode(F.sequence("_b", "_e"))).drop("_b", "_e")
    return places


def timed(picks: DataFrame) -> DataFrame:
    return picks.select("pick_id", "tid", "pha", C.epoch_seconds(F.col("peak")).alias("t")).where(F.col("pha").isin("P", "S") & F.col("t").isNotNull())


def coarsest(picks: DataFrame, stations: DataFrame, s: Search) -> DataFrame:
    """Picks with the coarsest blocks around their stations, and the bins in which they may count."""
    cast = timed(picks).join(blocks(stations, s), "tid")
    return reached(cast, s, s.levels).withColumn("bin", F.explode(F.sequence("first", "last"))).drop("first", "last")


def unplaced(picks: DataFrame, stations: DataFrame, s: Search) -> DataFrame:
    """The rows of ``coarsest`` without places: one row for all places that a station is listed at."""
    near, far = reach(s, s.levels)
    hull = blocks(stations, s).withColumns({"near": near, "far": far}).where(F.col("near") <= s.cutoff_km + SLACK).groupBy("tid", "by", "bx").agg(F.min("near").alias("near"), F.max("far").alias("far"))
    cast = begins(timed(picks).join(hull, "tid"), s, s.levels, F.col("near"), F.col("far"))
    return cast.withColumn("bin", F.explode(F.sequence("first", "last"))).drop("first", "last", "near", "far")


def placed(cast: DataFrame, stations: DataFrame, s: Search) -> DataFrame:
    """Rows of ``unplaced`` as those of ``coarsest``; the places (checked to be few) go to every task."""
    places = stations.select(F.col("id").alias("tid"), "latitude", "longitude")
    return reached(cast.join(F.broadcast(places), "tid"), s, s.levels).where(F.col("bin").between(F.col("first"), F.col("last"))).drop("first", "last")


def dealt(rows: DataFrame, tasks: int, keys: list[str]) -> DataFrame:
    """Rows dealt out by ``keys`` over at least ``tasks`` tasks, so that what a task sorts does not grow with the picks.
    Few small rows come in, so the number is given: Spark would put them together."""
    return rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism), *keys)


def bounded(cast: DataFrame, s: Search) -> DataFrame:
    """The rows of the blocks and bins that may hold an event: stations with P, with S and with both are counted over
    all picks that may count there, each once."""
    where = [*TOP, *PLACE]
    station, whole = Window.partitionBy(*where, "tid").orderBy("pick_id"), Window.partitionBy(*where)
    every = station.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    has = lambda pha: F.max((F.col("pha") == pha).cast("int")).over(every)
    own = cast.withColumns({"_p": has("P"), "_s": has("S"), "_one": (F.row_number().over(station) == 1).cast("int")})
    n = lambda c: F.sum(F.col("_one") * c).over(whole)
    return own.withColumns({"n_p": n(F.col("_p")), "n_s": n(F.col("_s")), "n_both": n(F.col("_p") * F.col("_s"))}).where(s.enough()).select(cast.columns)


def divided(cast: DataFrame, s: Search, level: int) -> DataFrame:
    """The rows of each block in the four blocks, and of each bin in the two bins, of the ``level`` below."""
    ny, nx = s.shape
    parts = F.explode(F.array(*[F.struct((F.col("by") * 2 + i).alias("by"), (F.col("bx") * 2 + j).alias("bx")) for i in (0, 1) for j in (0, 1)]))
    rows = cast.withColumns({"_at": parts, "_begin": F.col("bin") * 2}).drop("by", "bx", "bin").withColumns({"by": F.col("_at.by"), "bx": F.col("_at.bx")}).drop("_at")
    rows = reached(rows.where((F.col("by") < -(-ny // (1 << level))) & (F.col("bx") < -(-nx // (1 << level)))), s, level)
    begin, end = F.greatest(F.col("first"), F.col("_begin")), F.least(F.col("last"), F.col("_begin") + 1)
    return rows.where(begin <= end).withColumn("bin", F.explode(F.sequence(begin, end))).drop("first", "last", "_begin")


def votes(picks: DataFrame, stations: DataFrame, s: Search, tasks: int = 1, events: DataFrame | None = None) -> DataFrame:
    """Rows of a pick and a cell and bin that may hold an event; of those of ``events`` (cell, shift, bin) alone, if given."""
    few = stations.count() <= MOST_PLACES
    cast = (unplaced if few else coarsest)(picks, stations, s)
    if events is not None:
        flat = F.floor(F.col("cell") / len(s.depths))
        at = events.select(F.floor(flat / s.shape[1]).alias("by"), F.pmod(flat, F.lit(s.shape[1])).alias("bx"), (F.col("bin") - F.col("shift")).alias("bin")).distinct()
        cast = cast.join(at.select(*(F.shiftright(c, s.levels).alias(c) for c in PLACE)).distinct(), PLACE, "left_semi")
    cast = dealt(cast, tasks, PLACE).withColumns(dict(zip(TOP, map(F.col, PLACE))))
    cast = bounded(placed(cast, stations, s) if few else cast, s)
    for level in reversed(range(s.levels)):
        cast = bounded(divided(cast, s, level), s)
    return cast if events is None else cast.join(at, PLACE, "left_semi")


def members(cast: DataFrame, s: Search) -> DataFrame:
    """The picks of each (cell, shift, bin): of each station and phase the one next to the middle of the bin, and of
    these the ones within the tolerance of their ``mean``. Bins are twice the tolerance wide, and lie once more shifted
    by half."""
    nx, size, top = s.shape[1], 2 * s.tolerance, [c for c in TOP if c in cast.columns]
    depths = F.posexplode(F.array(*map(F.lit, s.depths))).alias("_k", "depth")
    lat, lon = F.col("by") * s.step + s.extent[0], F.col("bx") * s.step + s.extent[2]
    at = cast.select("*", lat.alias("lat"), lon.alias("lon"), depths).withColumn("km", C.haversine_km(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))).where(F.col("km") <= s.cutoff_km)
    at = at.withColumns({"origin": F.col("t") - C.hypocentral_km(F.col("km"), F.col("depth")) * slowness(s), "cell": (F.col("by") * nx + F.col("bx")) * len(s.depths) + F.col("_k")})
    # A bin belongs to the rows of the bin of the search in which it begins.
    shifts = F.explode(F.array(F.struct(F.lit(0).alias("shift"), F.floor(F.col("origin") / size).alias("own")), F.struct(F.lit(1).alias("shift"), F.floor(F.col("origin") / size + 0.5).alias("own"))))
    at = at.withColumn("x", shifts).where(F.col("x.own") - F.col("x.shift") == F.col("bin"))
    late = F.col("origin") - (F.col("x.own") - F.col("x.shift") * 0.5) * size
    where = [*top, "cell", "lat", "lon", "depth", "shift", "bin"]
    one = at.select(*top, "cell", "lat", "lon", "depth", "x.shift", F.col("x.own").alias("bin"), "tid", "pha", F.struct(F.abs(late - s.tolerance).alias("off"), "pick_id", late.alias("late")).alias("x"))
    chosen = one.groupBy(*where, "tid", "pha").agg(F.min("x").alias("x")).select(*where, "tid", "pha", "x.pick_id", "x.late")
    return chosen.withColumn("mean", F.avg("late").over(Window.partitionBy(*where))).where(F.abs(F.col("late") - F.col("mean")) <= s.tolerance)


def candidates(cast: DataFrame, s: Search) -> DataFrame:
    """(cell, shift, bin) that make an event: how many picks of which kinds it has, their spread and its origin time. Its
    picks (``members``) are not kept: few candidates become events."""
    own = members(cast, s)
    where = [*(c for c in TOP if c in cast.columns), "cell", "lat", "lon", "depth", "shift", "bin", "mean"]
    off = F.pow(F.col("late") - F.col("mean"), F.lit(2))
    by_station = own.groupBy(*where, "tid").agg(F.count_if(F.col("pha") == "P").alias("p"), F.count_if(F.col("pha") == "S").alias("s"), F.sum(off).alias("q"))
    n = {"n_p": F.sum("p"), "n_s": F.sum("s"), "n_both": F.sum(F.col("p") * F.col("s")), "spread": F.sqrt(F.sum("q") / F.sum(F.col("p") + F.col("s")))}
    found = by_station.groupBy(*where).agg(*(c.alias(k) for k, c in n.items())).drop(*TOP)
    begin = (F.col("bin") - F.col("shift") * 0.5) * 2 * s.tolerance
    return found.where(s.enough()).withColumns({"n_picks": F.col("n_p") + F.col("n_s"), "origin": begin + F.col("mean")}).drop("mean")


def strongest(found: DataFrame, seconds: float, cell_deg: float) -> DataFrame:
    """Non-maximum suppression: a candidate stays if no better one is within ``seconds`` and ``cell_deg`` degrees
    of it. Better: more picks, then less spread (to a millionth of a second), then the smaller cell, shift and
    bin. Only the best of each block of that size can stay; it meets the best of the 26 blocks around."""
    block = {"bt": F.floor(F.col("origin") / seconds), "by": F.floor(F.col("lat") / cell_deg), "bx": F.floor(F.col("lon") / cell_deg)}
    order = F.struct(-F.col("n_picks"), F.round("spread", 6), F.col("cell"), F.col("shift"), F.col("bin"))
    ranked = found.withColumns(block).withColumn("_order", order)
    own = F.row_number().over(Window.partitionBy(*block).orderBy("_order"))
    best = ranked.withColumn("_rank", own).where("_rank = 1").drop("_rank")
    around = F.explode(F.array(*[F.struct((F.col("bt") + i).alias("bt"), (F.col("by") + j).alias("by"), (F.col("bx") + k).alias("bx")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if i or j or k]))
    # Every candidate may drop a neighbour, the best of its block for all of them or not.
    rivals = ranked.select(F.col("origin").alias("_t"), F.col("lat").alias("_y"), F.col("lon").alias("_x"), F.col("_order").alias("_o"), around.alias("_b")).select("_t", "_y", "_x", "_o", "_b.*")
    met = [best[c] == rivals[c] for c in block]
    near = (F.abs(F.col("_t") - F.col("origin")) <= seconds) & (F.abs(F.col("_y") - F.col("lat")) <= cell_deg) & (F.abs(F.col("_x") - F.col("lon")) <= cell_deg)
    return best.join(rivals, [*met, near & (F.col("_o") < F.col("_order"))], "left_anti").drop(*block, "_order").withColumn("event_id", F.xxhash64("cell", "shift", "bin"))


def associate(picks: DataFrame, stations: DataFrame, search: Search) -> tuple[DataFrame, DataFrame]:
    """Events (event_id, time, lat, lon, depth, counts) and assignments (event_id, pick_id, tid, pha, residual). Of
    each station and phase an event has one pick at most, within the tolerance of its origin time. A pick that several
    events have goes to the one of most picks, then least spread; an event that keeps too few is dropped. The counts
    are those of the assignments."""
    tasks, stations = -(-picks.count() // TASK_PICKS), cut(stations.select("id", "latitude", "longitude"), "places")
    found = cut(candidates(votes(picks, stations, search, tasks), search), "candidates")
    events = cut(strongest(found, 4 * search.tolerance, 10 * search.step), "events")
    order = ["cell", "shift", "bin", "event_id", "n_picks", "spread"]
    own = members(votes(picks, stations, search, tasks, events), search).join(events.select(*order), order[:3])
    first = F.struct(-F.col("n_picks"), F.round("spread", 6), *order[:3], "event_id", "tid", "pha", (F.col("late") - F.col("mean")).alias("residual"))
    best = cut(own.groupBy("pick_id").agg(F.min(first).alias("x")).select("x.event_id", "pick_id", "x.tid", "x.pha", "x.residual"), "assignments")
    by_station = best.groupBy("event_id", "tid").agg(F.count_if(F.col("pha") == "P").alias("p"), F.count_if(F.col("pha") == "S").alias("s"))
    kept = by_station.groupBy("event_id").agg(F.sum("p").alias("n_p"), F.sum("s").alias("n_s"), F.sum(F.col("p") * F.col("s")).alias("n_both")).where(search.enough())
    out = events.select("event_id", F.timestamp_micros((F.col("origin") * 1e6).cast("long")).cast("timestamp_ntz").alias("time"), "lat", "lon", "depth").join(kept, "event_id")
    out = out.select("event_id", "time", "lat", "lon", "depth", (F.col("n_p") + F.col("n_s")).alias("n_picks"), "n_p", "n_s", "n_both")
    return out, best.join(kept.select("event_id"), "event_id", "left_semi")
