"""Array operators that need a Fourier transform: numpy over Arrow batches of traces, a trace a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C


def band_gain(n: int, rate: float, low: float | None, high: float | None, order: int) -> np.ndarray:
    """Gain of a Butterworth filter run forward and backward (no phase shift)."""
    f = np.fft.rfftfreq(n, 1 / rate)
    gain = np.ones(len(f))
    with np.errstate(divide="ignore", over="ignore"):
        if low:
            gain /= 1 + np.where(f > 0, (low / np.maximum(f, 1e-300)) ** (2 * order), np.inf)
        if high:
            gain /= 1 + (f / high) ** (2 * order)
    return gain


def filtered(x: np.ndarray, rate: float, low: float | None = None, high: float | None = None, order: int = 4) -> np.ndarray:
    """Zero-phase Butterworth filter in the frequency domain. Unlike a recursive filter run twice it wraps
    around at the ends; traces are tapered before."""
    x = np.asarray(x, float)
    return np.fft.irfft(np.fft.rfft(x) * band_gain(len(x), rate, low, high, order), len(x)) if len(x) else x


def resampled(x: np.ndarray, rate: float, target: float) -> np.ndarray:
    """Linear interpolation at the centres of the new samples."""
    x = np.asarray(x, float)
    n = int(len(x) * target / rate)
    return np.interp((np.arange(n) + 0.5) * rate / target - 0.5, np.arange(len(x)), x) if len(x) else x


def spectrogram(x: np.ndarray, rate: float, nperseg: int = 256) -> np.ndarray:
    """Power density by frequency and time: Hann windows with half overlap, mean removed, one-sided."""
    x = np.asarray(x, float)
    step = nperseg // 2
    if len(x) < nperseg:
        return np.zeros((nperseg // 2 + 1, 0))
    parts = np.lib.stride_tricks.sliding_window_view(x, nperseg)[::step]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    power = np.abs(np.fft.rfft((parts - parts.mean(1, keepdims=True)) * window, axis=1)) ** 2 / (rate * (window**2).sum())
    power[:, 1 : None if nperseg % 2 else -1] *= 2
    return power.T


def paz(f: np.ndarray, poles: list[complex], zeros: list[complex], gain: float) -> np.ndarray:
    """Response of poles and zeros at frequencies ``f``."""
    s = 2j * np.pi * f
    out = np.full(len(f), gain, complex)
    for z in zeros:
        out *= s - z
    for p in poles:
        out /= s - p
    return out


#: The Wood-Anderson seismograph over ground velocity (period 0.8 s, damping 0.7); the gain is its
#: sensitivity.
WOOD_ANDERSON = {"poles": [-5.49779 - 5.60886j, -5.49779 + 5.60886j], "zeros": [0j], "gain": 2080.0}


def wood_anderson(x: np.ndarray, rate: float, poles: list[complex], zeros: list[complex], gain: float, water: float = 20.0, pre: tuple[float, float, float, float] = (0.1, 0.2, 40.0, 45.0)) -> np.ndarray:
    """Remove an instrument's response (water level in dB, cosine pre-filter) and simulate a Wood-Anderson."""
    x = np.asarray(x, float)
    f = np.fft.rfftfreq(len(x), 1 / rate)
    response = paz(f, poles, zeros, gain)
    size = np.abs(response)
    floor = size.max() * 10 ** (-water / 20)
    response = np.where(size < floor, np.where(size > 0, response / np.maximum(size, 1e-300), 1) * floor, response)
    a, b, c, d = pre
    shape = np.interp(f, [a, b, c, d], [0, 1, 1, 0], left=0, right=0)
    shape = 0.5 - 0.5 * np.cos(np.pi * shape)
    return np.fft.irfft(np.fft.rfft(x) / response * shape * paz(f, **WOOD_ANDERSON), len(x))


def map_samples(traces: DataFrame, f: Callable[[np.ndarray, float], np.ndarray], out: str = "samples", samples: str = "samples", rate: str = "rate_hz") -> DataFrame:
    """Apply ``f(samples, rate)`` to every trace."""
    base = [x for x in traces.schema.fields if x.name != out]
    schema = T.StructType([*base, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            new = [f(np.asarray(x, float), r).tolist() if x is not None else None for x, r in zip(part[samples], part[rate])]
            yield part.assign(**{out: new})[[x.name for x in schema.fields]]

    return traces.mapInPandas(run, schema)


def band_pass(traces: DataFrame, low: float, high: float, order: int = 4, **names: str) -> DataFrame:
    return map_samples(traces, lambda x, r: filtered(x, r, low, high, order), **names)


def high_pass(traces: DataFrame, low: float, order: int = 4, **names: str) -> DataFrame:
    return map_samples(traces, lambda x, r: filtered(x, r, low, None, order), **names)


def resample(traces: DataFrame, target: float, **names: str) -> DataFrame:
    return map_samples(traces, lambda x, r: resampled(x, r, target), **names)


def simulate(traces: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Wood-Anderson traces, once for each trace before picks are cut out of it. ``responses``: keys, poles
    and zeros (arrays of [re, im]), gain; traces without one get null samples."""
    both = traces.join(responses, keys, "left")
    schema = T.StructType([f for f in traces.schema.fields if f.name != "samples"] + [T.StructField("samples", T.ArrayType(T.DoubleType()))])

    def one(x, rate, poles, zeros, gain):
        if poles is None or gain is None or x is None:
            return None
        return wood_anderson(np.asarray(x, float), rate, [complex(*p) for p in poles], [complex(*z) for z in zeros], gain).tolist()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            new = [one(*v) for v in zip(part.samples, part.rate_hz, part.poles, part.zeros, part.gain.where(part.gain.notna(), None))]
            yield part.assign(samples=new)[[f.name for f in schema.fields]]

    return both.mapInPandas(run, schema)


def raw_amplitudes(picks: DataFrame, traces: DataFrame, keys: list[str], before: float = 3.0, after: float = 10.0, low: float = 1.0, taper_seconds: float = 60.0) -> DataFrame:
    """Largest component peak around each pick, of detrended, tapered, high-passed traces; NaN where no
    component has the whole window outside the taper."""
    tapered = C.taper(F.col("samples"), F.col("rate_hz"), taper_seconds)
    prepared = traces.withColumn("samples", C.doubles(F.col("samples"))).withColumn("samples", C.detrend(F.col("samples"))).withColumn("samples", tapered)
    found = amplitudes(picks, high_pass(prepared, low), keys, before, after, taper_seconds, traces)
    return found.withColumnRenamed("amp_raw", "amp_raw_peak").drop("amp")


def amplitudes(picks: DataFrame, traces: DataFrame, keys: list[str], before: float = 3.0, after: float = 10.0, taper_seconds: float = 60.0, times: DataFrame | None = None) -> DataFrame:
    """For each pick the mean of the horizontals' peaks (as for magnitudes) and the largest of all components' (``amp``,
    ``amp_raw``), both ends of the window included; NaN where no trace of its keys has the whole window outside the
    taper. ``times``: traces of the same keys, times and lengths that are cheaper to read than ``traces``.

    A window is measured once for each trace, for all picks that have it, and its measures are joined back. So the work
    grows with the picks and with the samples (a trace has no more windows than samples), not with pairs of picks and traces."""
    grid, window = [*keys, "t0", "rate_hz"], ["_start", "_length"]
    lengths = (traces if times is None else times).groupBy(*grid).agg(F.max(F.size("samples")).alias("_most"))
    first = C.epoch_seconds(F.col("peak")) - C.epoch_seconds(F.col("t0"))
    start = F.round((first - before) * F.col("rate_hz")).cast("int")
    length = F.round((first + after) * F.col("rate_hz")).cast("int") + 1 - F.col("_start")
    placed = picks.join(lengths, keys, "left").withColumn("_start", start).withColumn("_length", length)
    asked = placed.where("_start >= 0 AND _length > 0 AND _start + _length <= _most").select(*grid, *window).distinct()
    margin = F.ceil(F.least(F.col("rate_hz") * taper_seconds, (F.size("samples") - 1) * F.lit(0.05)) - 1e-9).cast("int")
    peaks = traces.join(asked, grid).select(*grid, *window, "component", C.peak_in_window(F.col("samples"), F.col("_start"), F.col("_length"), margin).alias("peak_abs"))
    flat = F.when(F.col("component").isin("N", "E", "1", "2"), F.col("peak_abs"))
    measured = peaks.groupBy(*grid, *window).agg(F.sum(flat).alias("_sum"), F.count(flat).alias("_n"), F.max("peak_abs").alias("_top"))
    found = placed.join(measured, [*grid, *window], "left").groupBy(*picks.columns)
    nan = F.lit(float("nan"))
    return found.agg(F.coalesce(C.ratio(F.sum("_sum"), F.sum("_n")), nan).alias("amp"), F.coalesce(F.max("_top"), nan).alias("amp_raw"))


def moveout(traces: DataFrame, stations: DataFrame, event: tuple[float, float, float], gain: float = 3.0, vp: float = 6.0, ratio: float = 1.75) -> DataFrame:
    """A record section as a table, in order of distance: each trace (of a station, ``tid``) with its distance from the
    event (latitude, longitude, depth) in km, its largest amplitude, the samples scaled to ``gain`` and shifted to the
    distance (a trace of zeros stays a line there), and the expected seconds of P and S."""
    km = C.haversine_km(F.lit(event[0]), F.lit(event[1]), F.col("latitude"), F.col("longitude"))
    placed = traces.join(stations.select(F.col("id").alias("tid"), "latitude", "longitude"), "tid").withColumn("km", km).drop("latitude", "longitude")
    tp, ts = C.travel_seconds(C.hypocentral_km(F.col("km"), F.lit(event[2])), vp, ratio)
    scaled = placed.withColumn("_x", C.doubles(F.col("samples"))).withColumn("peak", F.array_max(F.transform("_x", lambda v: F.abs(v))))
    line = F.transform("_x", lambda v: F.coalesce(v / F.nullif(F.col("peak"), F.lit(0.0)), F.lit(0.0)) * gain + F.col("km"))
    return scaled.withColumns({"line": line, "p_seconds": tp, "s_seconds": ts}).drop("_x", "samples").orderBy("km", "tid")


def moveout_picks(picks: DataFrame, section: DataFrame, time: Column, before: float = 5.0, after: float = 45.0) -> DataFrame:
    """The picks of a section's stations from ``before`` to ``after`` seconds around the event, with their distance and
    how late they are after the expected time."""
    places = section.select("tid", "km", "p_seconds", "s_seconds").distinct()
    seconds = C.epoch_seconds(F.col("peak")) - C.epoch_seconds(time)
    found = picks.join(places, "tid").withColumn("seconds", seconds).where(F.col("seconds").between(-before, after))
    return found.withColumn("late", F.col("seconds") - F.when(F.col("pha") == "P", F.col("p_seconds")).otherwise(F.col("s_seconds"))).drop("p_seconds", "s_seconds")


def merged(segments: DataFrame, keys: list[str], length: int) -> DataFrame:
    """One trace of ``length`` samples for each of ``keys``, from segments (offset in samples, samples): gaps become 0,
    what reaches beyond the ends is trimmed, and where segments overlap the earlier one stays. A trace has few
    segments (those with many are guarded out before), and they are laid one after the other inside the array."""
    parts = segments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("offset", C.doubles(F.col("samples")).alias("samples")))).alias("_parts"))

    def lay(done: Column, part: Column) -> Column:
        gap = F.array_repeat(F.lit(0.0), F.greatest(part["offset"] - F.size(done), F.lit(0)))
        known = F.greatest(F.size(done) - part["offset"], F.lit(0))
        return F.concat(done, gap, F.slice(part["samples"], known + 1, F.greatest(F.size(part["samples"]) - known, F.lit(0))))

    laid = F.aggregate("_parts", F.array().cast("array<double>"), lay)
    whole = F.slice(F.concat(laid, F.array_repeat(F.lit(0.0), length)), 1, length)
    return parts.select(*keys, whole.alias("samples"))


def normalised(traces: DataFrame, keys: list[str], samples: str = "samples") -> DataFrame:
    """Divide each trace by the sample deviation of the absolute values of all samples of its ``keys``, plus 1e-10.
    Traces give their moments about their own mean, which are pooled, so samples are not exploded."""
    x = C.doubles(F.col(samples))
    parts = traces.select(*keys, F.transform(x, lambda v: F.abs(v)).alias("_x")).where(F.size("_x") > 0).select(*keys, F.size("_x").alias("_n"), (C.total(F.col("_x")) / F.size("_x")).alias("_m"), "_x")
    moments = parts.select(*keys, "_n", "_m", C.let(F.col("_m"), lambda m: C.total(F.transform("_x", lambda v: (v - m) * (v - m)))).alias("_q"))
    pooled = moments.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_q").alias("_q"), F.sum(F.col("_n") * F.col("_m")).alias("_s"), F.sum(F.col("_n") * F.col("_m") * F.col("_m")).alias("_ss"))
    between = F.greatest(F.col("_ss") - F.col("_s") * F.col("_s") / F.col("_n"), F.lit(0.0))
    scale = pooled.select(*keys, (F.sqrt((F.col("_q") + between) / F.nullif(F.col("_n") - 1, F.lit(0))) + 1e-10).alias("_scale"))
    return traces.join(scale, keys, "left").withColumn(samples, C.let(F.col("_scale"), lambda s: F.transform(x, lambda v: v / s))).drop("_scale")


def spectrograms(traces: DataFrame, nperseg: int = 256) -> DataFrame:
    """Add ``power`` (array by frequency of arrays by time)."""
    schema = T.StructType([*traces.schema.fields, T.StructField("power", T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(power=[spectrogram(x, r, nperseg).tolist() for x, r in zip(part.samples, part.rate_hz)])

    return traces.mapInPandas(run, schema)
