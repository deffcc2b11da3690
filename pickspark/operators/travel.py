"""Travel times: a layered earth, tables of its times on uneven grids, and looking them up."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of a table that may be sent to every task (8 MB).
MOST_VALUES = 1 << 20


def layered_seconds(km: np.ndarray, depth: np.ndarray, tops: list[float], speeds: list[float]) -> np.ndarray:
    """First arrivals at the surface, ``km`` away from sources at ``depth``: the direct ray, and head waves along the
    top of each layer below the source that is faster than all above it. ``tops`` begin with 0; the last layer has no bottom."""
    km, depth = (np.asarray(x, float) for x in np.broadcast_arrays(km, depth))
    edges = np.array([*tops[1:], np.inf])
    v = np.array(speeds, float)
    # Thickness of each layer above the source.
    above = np.clip(np.minimum(edges, depth[..., None]) - np.array(tops), 0, None)
    used = above > 0
    fastest = np.where(used, v, 0).max(-1)
    # The direct ray: its slowness along the surface by bisection on the sine at the fastest layer it crosses.
    lo, hi = np.zeros(km.shape), np.ones(km.shape)

    def cosines(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sine = np.where(used, share[..., None] * v / np.maximum(fastest, 1e-300)[..., None], 0)
        return sine, np.sqrt(np.maximum(1 - sine * sine, 1e-30))

    for _ in range(80):
        middle = (lo + hi) / 2
        sine, cosine = cosines(middle)
        far = (above * sine / cosine).sum(-1) < km
        lo, hi = np.where(far, middle, lo), np.where(far, hi, middle)
    _, cosine = cosines(lo)
    share = lo / np.maximum(fastest, 1e-300)
    # Time as delay plus slowness times distance, which holds at any slowness near the right one.
    out = share * km + (above * cosine / v).sum(-1)
    own = np.searchsorted(tops, depth, "right") - 1
    out = np.where(used.any(-1), out, km / v[np.maximum(own, 0)])
    for n in range(1, len(v)):
        down = np.clip(edges[:n] - np.maximum(np.array(tops[:n]), depth[..., None]), 0, None)
        # Only a layer that is faster than all above it carries a wave whose legs reach it at the critical angle.
        if not np.all(v[n] > v[:n]):
            continue
        root = np.sqrt(np.maximum(1 / v[:n] ** 2 - 1 / v[n] ** 2, 0))
        legs = down + (edges[:n] - np.array(tops[:n]))  # down from the source, and up through all
        tan = 1 / v[n] / np.maximum(root, 1e-300)
        least = (legs * tan).sum(-1)
        wave = km / v[n] + (legs * root).sum(-1)
        out = np.where((depth <= tops[n]) & (km >= least), np.minimum(out, wave), out)
    return out


def layered_table(points: DataFrame, tops: list[float], speeds: dict[str, list[float]]) -> DataFrame:
    """``distance`` and ``depth`` of ``points`` with a row for each phase: ``pha`` and ``seconds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            km, depth = (batch.column(c).to_numpy() for c in ("distance", "depth"))
            for pha, v in speeds.items():
                yield pa.RecordBatch.from_arrays([pa.array([pha] * len(km)), batch.column("distance"), batch.column("depth"), pa.array(layered_seconds(km, depth, tops, v))], names=["pha", "distance", "depth", "seconds"])

    return points.select(F.col("distance").cast("double"), F.col("depth").cast("double")).mapInArrow(run, "pha string, distance double, depth double, seconds double")


def write_table(rows: DataFrame, path: str) -> None:
    """Rows of pha, distance, depth, seconds; refuses to overwrite."""
    rows.select("pha", "distance", "depth", "seconds").write.mode("errorifexists").parquet(path)


@dataclass(frozen=True)
class Table:
    """Sorted distances and depths, not evenly spaced, and the seconds between, of each phase."""

    distances: dict[str, np.ndarray]
    depths: dict[str, np.ndarray]
    seconds: dict[str, np.ndarray]

    def at(self, pha: str, km: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Bilinear between the four values around; NaN outside the table."""
        x, y, t = self.distances[pha], self.depths[pha], self.seconds[pha]
        i = np.clip(np.searchsorted(x, km, "right") - 1, 0, len(x) - 2)
        k = np.clip(np.searchsorted(y, depth, "right") - 1, 0, len(y) - 2)
        u, w = (km - x[i]) / (x[i + 1] - x[i]), (depth - y[k]) / (y[k + 1] - y[k])
        inside = (km >= x[0]) & (km <= x[-1]) & (depth >= y[0]) & (depth <= y[-1])
        found = t[i, k] * (1 - u) * (1 - w) + t[i + 1, k] * u * (1 - w) + t[i, k + 1] * (1 - u) * w + t[i + 1, k + 1] * u * w
        return np.where(inside, found, np.nan)


def table_of(rows: DataFrame) -> Table:
    """From rows of pha, distance, depth, seconds. Every distance must come with every depth, once."""
    if rows.limit(MOST_VALUES + 1).count() > MOST_VALUES:
        raise ValueError(f"a travel-time table of more than {MOST_VALUES} values")
    found = rows.select("pha", "distance", "depth", "seconds").toPandas()
    distances, depths, seconds = {}, {}, {}
    for pha, own in found.groupby("pha"):
        x, y = np.unique(own.distance.to_numpy(float)), np.unique(own.depth.to_numpy(float))
        if len(own) != len(x) * len(y) or own.duplicated(["distance", "depth"]).any() or own.isna().any(axis=None):
            raise ValueError(f"the table of {pha} is not a whole grid of distances and depths")
        if min(len(x), len(y)) < 2:
            raise ValueError(f"the table of {pha} needs two distances and two depths")
        distances[pha], depths[pha] = x, y
        seconds[pha] = own.sort_values(["distance", "depth"]).seconds.to_numpy(float).reshape(len(x), len(y))
    return Table(distances, depths, seconds)


def read_table(spark: SparkSession, path: str) -> Table:
    return table_of(spark.read.parquet(path))


def looked_up(points: DataFrame, table: Table, pha: str = "pha", distance: str = "distance", depth: str = "depth", out: str = "seconds") -> DataFrame:
    """Add ``out`` and ``outside``: whether the table does not reach the point (``out`` is null then), or has no such
    phase, or the point is not known. The table is small by its own check and goes to every task."""
    sent = points.sparkSession.sparkContext.broadcast(table)
    kept = [f for f in points.schema.fields if f.name not in (out, "outside")]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType()), T.StructField("outside", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for batch in batches:
            km, z = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (distance, depth))
            phases = np.array(batch.column(pha).to_pylist(), object)
            found = np.full(batch.num_rows, np.nan)
            for p in t.seconds:
                own = np.flatnonzero(phases == p)
                found[own] = t.at(p, km[own], z[own])
            gone = np.isnan(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(found, mask=gone), pa.array(gone)], names=[f.name for f in schema.fields])

    return points.mapInArrow(run, schema)
