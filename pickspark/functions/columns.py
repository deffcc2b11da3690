"""Column functions: dates of the form YYYY.DDD, station ids, distances, travel times, array arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
#: Bands from best to worst, and event types by class.
BAND_PRIORITY = ["HH", "EH", "EP", "EL", "HN", "SH", "SL", "BH", "DP", "CN"]
EVENT_CLASS = {"earthquake": "eq", "quarry blast": "px", "explosion": "px", "ice quake": "su", "landslide": "su"}
CLASS_ORDER = ["eq", "px", "no", "su"]


# Dates


def parse_year_day(c: Column) -> Column:
    """'YYYY.DDD' as a date; null where it does not parse."""
    return F.to_date(F.try_to_timestamp(c, F.lit("yyyy.DDD")))


def year_day(c: Column) -> Column:
    return F.date_format(c, "yyyy.DDD")


def as_time(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970, with microseconds, of a time without zone (session time zone UTC)."""
    return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)


def windows_overlap(start: Column, end: Column, d0: Column, d1: Column) -> Column:
    """Whether the days [start, end] meet the days [d0, d1). Unknown bounds are open."""
    return (start.isNull() | (start < d1)) & (end.isNull() | (end >= d0))


def overlap_days(start: Column, end: Column, d0: Column, d1: Column) -> Column:
    """How many days of [d0, d1) lie in [start, end]."""
    lo = F.greatest(d0, F.coalesce(start, d0))
    hi = F.least(d1, F.date_add(F.coalesce(end, F.date_sub(d1, 1)), 1))
    return F.greatest(F.datediff(hi, lo), F.lit(0))


# Ids


def id_part(c: Column, n: int) -> Column:
    """Part ``n`` of NET.STA.LOC.CHA; null if there is none."""
    return F.get(F.split(c, r"\."), F.lit(n))


def network_of(c: Column) -> Column:
    return F.when(c.contains("."), id_part(c, 0)).otherwise(F.lit("unknown"))


def band_of(channel: Column) -> Column:
    return F.substring(channel, 1, 2)


def component_of(channel: Column) -> Column:
    """The last letter, with 1 and 2 as N and E."""
    return F.translate(F.right(channel, F.lit(1)), "12", "NE")


def band_codes(channels: Column) -> Column:
    """A comma list of channels as a sorted comma list of distinct two-letter bands."""
    codes = F.transform(F.split(channels, ","), lambda x: F.substring(F.trim(x), 1, 2))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(codes, lambda x: x != ""))), ",")


def best_band(channels: Column, priority: list[str] = BAND_PRIORITY) -> Column:
    """The best band of an array; null when none is known."""
    clean = F.transform(channels, lambda x: F.trim(x))
    return F.get(F.array_intersect(F.array(*map(F.lit, priority)), clean), F.lit(0))


def unit_id(stations: Column, start: Column, end: Column) -> Column:
    """A content-derived id of a work unit: equal content, equal id."""
    day = lambda c: F.date_format(c, "yyyyDDD")
    content = F.concat_ws("|", F.array_sort(stations), day(start), day(end))
    return F.concat(day(start), F.lit("-"), day(end), F.lit("-"), F.substring(F.sha1(content.cast("binary")), 1, 12))


def phase_of(phase: Column) -> Column:
    """Pg, Pn, ... as P; Sg, Sn, ... as S."""
    return F.upper(F.left(phase, F.lit(1)))


def event_class(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in EVENT_CLASS.items() for x in kv])[kind]


# Object keys of archives


def padded_key(net: Column, sta: Column, loc: Column, cha: Column, day: Column) -> Column:
    """Fixed-width names: net(2) sta(5, '_') cha(3) loc(3, '_') year doy."""
    name = F.concat(net, F.rpad(sta, 5, "_"), cha, F.rpad(loc, 3, "_"), F.date_format(day, "yyyyDDD"), F.lit(".ms"))
    return F.concat(F.date_format(day, "yyyy"), F.lit("/"), F.date_format(day, "yyyy_DDD"), F.lit("/"), name)


def dotted_key(net: Column, sta: Column, loc: Column, cha: Column, day: Column) -> Column:
    return F.concat(net, F.lit("/"), F.date_format(day, "yyyy/yyyy.DDD"), F.lit("/"), F.concat_ws(".", sta, net, cha, loc, F.lit("D"), F.date_format(day, "yyyy.DDD")))


def versioned_key(net: Column, sta: Column, day: Column, version: Column) -> Column:
    """One object a station and day, with the number of its version."""
    return F.concat(net, F.lit("/"), F.date_format(day, "yyyy/DDD"), F.lit("/"), F.concat_ws(".", sta, net, F.date_format(day, "yyyy.DDD")), F.lit("#"), version.cast("string"))


#: What the names of each layout look like; the groups are named in KEY_PARTS.
KEY_LAYOUTS = {
    "padded": r"^(..)(.{5})(...)(...)(\d{4})(\d{3})\.ms$",
    "dotted": r"^([^.#]+)\.([^.#]+)\.([^.#]+)\.([^.#]*)\.D\.(\d{4})\.(\d{3})$",
    "versioned": r"^([^.#]+)\.([^.#]+)\.(\d{4})\.(\d{3})#(\d+)$",
}
KEY_PARTS = {
    "padded": ["net", "sta", "channel", "loc", "yr", "doy"],
    "dotted": ["sta", "net", "channel", "loc", "yr", "doy"],
    "versioned": ["sta", "net", "yr", "doy", "version"],
}


def parse_key(path: Column) -> Column:
    """What an object's name says, of whichever layout it has: layout, net, sta, channel, loc, yr, doy, version; null if
    it has none. Names of whole stations have no channel and location; only they have a version."""
    whole = ("yr", "doy", "version")

    def parsed(layout: str, name: Column) -> Column:
        part = {p: F.regexp_extract(name, KEY_LAYOUTS[layout], i + 1) for i, p in enumerate(KEY_PARTS[layout])}
        text = {p: F.rtrim(F.translate(c, "_", " ")) if layout == "padded" else c for p, c in part.items()}
        fields = [text[p].cast("int").alias(p) if p in whole and p in text else text[p].alias(p) if p in text else F.lit(None).cast("int" if p in whole else "string").alias(p) for p in ("net", "sta", "channel", "loc", *whole)]
        return F.when(name.rlike(KEY_LAYOUTS[layout]), F.struct(F.lit(layout).alias("layout"), *fields))

    return let(F.regexp_extract(path, r"([^/]*)$", 1), lambda name: F.coalesce(*(parsed(x, name) for x in KEY_LAYOUTS)))


def parse_padded_key(path: Column) -> dict[str, Column]:
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    part = lambda a, n: F.rtrim(F.translate(F.substring(name, a, n), "_", " "))
    return {"net": part(1, 2), "sta": part(3, 5), "channel": part(8, 3), "loc": part(11, 3), "yr": F.substring(name, 14, 4).cast("int"), "doy": F.substring(name, 18, 3).cast("int")}


# Distances and travel times


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def degrees_of(km: Column) -> Column:
    return F.degrees(km / F.lit(EARTH_KM))


def hypocentral_km(epicentral: Column, depth: Column) -> Column:
    return F.sqrt(epicentral * epicentral + depth * depth)


def travel_seconds(km: Column, vp: float = 6.0, ratio: float = 1.75) -> tuple[Column, Column]:
    """P and S times at constant velocity."""
    return km / F.lit(vp), km * F.lit(ratio / vp)


def in_polygon(lat: Column, lon: Column, ring: Column) -> Column:
    """Whether the point is inside ``ring`` (array of structs lon, lat, closed or not), by ray casting. Points on its
    edges and corners are not inside."""
    n = F.size(ring)

    def met(p: Column, i: Column) -> Column:
        q = F.get(ring, F.pmod(i + 1, n))
        straddles = (p["lat"] > lat) != (q["lat"] > lat)
        at = p["lon"] + (lat - p["lat"]) * (q["lon"] - p["lon"]) / F.nullif(q["lat"] - p["lat"], F.lit(0.0))
        level = (p["lat"] == lat) & (q["lat"] == lat) & lon.between(F.least(p["lon"], q["lon"]), F.greatest(p["lon"], q["lon"]))
        corner = (p["lat"] == lat) & (p["lon"] == lon)
        return F.struct(F.when(straddles & (lon < at), 1).otherwise(0).alias("crossed"), (F.coalesce(straddles & (lon == at), F.lit(False)) | level | corner).alias("edge"))

    return let(F.transform(ring, met), lambda hits: ~F.exists(hits, lambda x: x["edge"]) & (F.aggregate(hits, F.lit(0), lambda a, x: a + x["crossed"]) % 2 == 1))


# Numbers


def nan_to_null(c: Column) -> Column:
    """NaN means 'not measurable'; aggregates must skip it as they skip null."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def softmax(values: Column) -> Column:
    powers = let(values, lambda v: let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
    return let(powers, lambda p: let(total(p), lambda t: F.transform(p, lambda x: x / t)))


def argmax_label(labels: list[str], values: list[Column]) -> Column:
    """The label of the largest value; of equal ones the first."""
    top = F.greatest(*values)
    out = F.lit(None).cast("string")
    for label, v in reversed(list(zip(labels, values))):
        out = F.when(v == top, F.lit(label)).otherwise(out)
    return out


# Arrays of samples


def doubles(samples: Column) -> Column:
    return F.transform(samples, lambda x: x.cast("double"))


def total(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda a, x: a + x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once. Without it, an expression that the optimizer moves
    into a lambda function would be evaluated for every element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def detrend(samples: Column) -> Column:
    """Without the least-squares line."""

    def of(x: Column) -> Column:
        n = F.size(x).cast("double")
        middle = (n - 1) / 2
        slope = F.when(n > 1, total(F.transform(x, lambda v, i: v * (i - middle))) * 12.0 / (n * (n * n - 1))).otherwise(0.0)
        line = F.struct((total(x) / n).alias("mean"), slope.alias("slope"), middle.alias("middle"))
        return let(line, lambda m: F.transform(x, lambda v, i: v - m["mean"] - m["slope"] * (i - m["middle"])))

    return let(samples, of)


def taper(samples: Column, rate: Column, seconds: float = 60.0, most: float = 0.05) -> Column:
    """Cosine taper of fixed length at both ends, at most a share of the trace."""

    def of(x: Column) -> Column:
        n = F.size(x)
        ends = F.struct(n.alias("n"), F.least(F.floor(rate * seconds), F.floor(n * F.lit(most))).cast("int").alias("length"))

        def weight(v: Column, i: Column, e: Column) -> Column:
            edge = F.least(i, e["n"] - 1 - i)
            return v * F.when(edge < e["length"], (1 - F.cos(F.lit(3.141592653589793) * edge / e["length"])) / 2).otherwise(1.0)

        return let(ends, lambda e: F.transform(x, lambda v, i: weight(v, i, e)))

    return let(samples, of)


def min_max(samples: Column) -> Column:
    def of(x: Column) -> Column:
        lo, hi = F.array_min(x), F.array_max(x)
        bounds = F.struct(lo.alias("lo"), F.nullif(hi - lo, F.lit(0.0)).alias("span"))
        return let(bounds, lambda b: F.transform(x, lambda v: F.coalesce((v - b["lo"]) / b["span"], F.lit(0.0))))

    return let(samples, of)


def peak_in_window(samples: Column, start: Column, length: Column, margin: Column | int = 0) -> Column:
    """Largest absolute sample of [start, start + length); null where the window leaves the trace or reaches
    into ``margin`` samples at either end (there the taper distorts)."""
    margin = F.lit(margin) if isinstance(margin, int) else margin
    inside = (start >= margin) & (start + length <= F.size(samples) - margin) & (length > 0)
    cut = F.slice(samples, F.greatest(start, F.lit(0)) + 1, F.greatest(length, F.lit(1)))
    return F.when(inside, F.array_max(F.transform(cut, lambda x: F.abs(x))))
