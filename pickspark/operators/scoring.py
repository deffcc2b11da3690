"""Window scoring with a pluggable model, picks from probability curves, and class decisions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

#: Models that may be sent to every task.
MOST_MODELS = 1000
#: A scorer takes samples (windows by length) and gives probabilities by class name.
Scorer = Callable[[np.ndarray], dict[str, np.ndarray]]


def ratio_scorer(short: int = 4, long: int = 16) -> Scorer:
    """A deterministic default: the ratio of short to long running energy, squashed to [0, 1)."""

    def score(windows: np.ndarray) -> dict[str, np.ndarray]:
        energy = np.cumsum(np.pad(windows.astype(float) ** 2, ((0, 0), (1, 0))), axis=1)
        at = np.arange(windows.shape[1])
        mean = lambda n: (energy[:, at + 1] - energy[:, np.maximum(at + 1 - n, 0)]) / np.minimum(at + 1, n)
        r = mean(short) / np.maximum(mean(long), 1e-12)
        return {"P": r / (1 + r), "S": (r / (1 + r)) ** 2}

    return score


def sliding_windows(traces: DataFrame, length: int, stride: int, samples: str = "samples") -> DataFrame:
    """A row for each window: ``offset`` and the cut ``window``; traces shorter than a window give none."""
    n = F.size(samples)
    starts = F.when(n >= length, F.sequence(F.lit(0), n - length, F.lit(stride)))
    return traces.withColumn("offset", F.explode(starts)).withColumn("window", F.slice(samples, F.col("offset") + 1, length)).drop(samples)


def score_windows(windows: DataFrame, make: Callable[[], Scorer], classes: list[str], column: str = "window") -> DataFrame:
    """Add a curve (array) for each class. ``make`` runs once for each Python worker's task."""
    base = [f for f in windows.schema.fields if f.name not in classes]
    schema = T.StructType([*base, *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in classes)])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make()
        for part in parts:
            part = part.reset_index(drop=True)
            out = {c: [None] * len(part) for c in classes}
            for _, rows in part.groupby(part[column].map(len)).groups.items():
                got = scorer(np.stack(part[column][rows].tolist()))
                for c in classes:
                    for i, curve in zip(rows, got[c].tolist()):
                        out[c][i] = curve
            yield part.assign(**out)[[f.name for f in schema.fields]]

    return windows.mapInPandas(run, schema)


def runs_of(curve: Column, least: float) -> Column:
    """Runs of samples at or over ``least``, as an array of start, peak (the first largest), end and peak value. NaN
    and null are below everything."""

    def of(p: Column) -> Column:
        over = lambda i: F.coalesce((F.get(p, i) >= least) & ~F.isnan(F.get(p, i)), F.lit(False))
        edges = lambda step: F.filter(F.transform(p, lambda _, i: F.when(over(i) & ~over(i + step), i)), lambda i: i.isNotNull())

        def run(at: Column) -> Column:
            part = F.slice(p, at["s"] + 1, at["e"] - at["s"] + 1)
            top = F.array_max(part)
            return F.struct(at["s"].alias("start"), (at["s"] + F.array_position(part, top) - 1).cast("int").alias("peak"), at["e"].alias("end"), top.alias("peak_value"))

        return F.transform(F.arrays_zip(edges(-1).alias("s"), edges(1).alias("e")), run)

    return C.let(curve, of)


def picks_from_curves(curves: DataFrame, keys: list[str], thresholds: dict[str, float]) -> DataFrame:
    """Runs of samples at or over a class's threshold: start, peak, end (sample numbers) and peak value. The runs
    are found inside the arrays: samples are not exploded and nothing is shuffled."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("pha"), runs_of(F.col(c), t).alias("runs")) for c, t in thresholds.items()]))
    return curves.select(*keys, each.alias("_x")).select(*keys, "_x.pha", F.inline("_x.runs"))


def decide(windows: DataFrame, labels: list[str] = C.CLASS_ORDER, drop: str = "no") -> DataFrame:
    """Add ``label``, the most probable class (of equal ones the first), and leave out windows of noise."""
    return windows.withColumn("label", C.argmax_label(labels, [F.col(x) for x in labels])).where(F.col("label") != drop)


def decide_by_peaks(curves: DataFrame, labels: list[str] = C.CLASS_ORDER) -> DataFrame:
    """As ``decide``, of each class's largest probability in a window's curves; noise stays."""
    peaks = curves.withColumns({x: F.array_max(x) for x in labels})
    return peaks.withColumn("label", C.argmax_label(labels, [F.col(x) for x in labels]))


def first_by_phase(picks: DataFrame, by: list[str], time: str = "peak") -> DataFrame:
    return picks.groupBy(*by).agg(F.min(time).alias("first_time"), F.min_by("pick_id", F.struct(F.col(time), F.col("pick_id"))).alias("first_pick"))


def at_weights(windows: DataFrame, weights: DataFrame) -> DataFrame:
    """Every window for every model; models are a handful of rows, and more than ``MOST_MODELS`` are refused."""
    n = weights.count()
    if n > MOST_MODELS:
        raise ValueError(f"{n} models, at most {MOST_MODELS} are sent to every task")
    return windows.join(F.broadcast(weights))


def scaled(probability: Column, factor: Column) -> Column:
    return F.least(F.greatest(probability * factor, F.lit(0.0)), F.lit(1.0))
