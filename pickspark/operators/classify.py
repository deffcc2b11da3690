"""Classification of three-component windows: before, score, after.

A window's components stay together in one row (an array a component), and go through the chain as a block of windows of
equal length: line removed, cosine taper, zero-phase band-pass, resampling, division by the deviation, spectrogram,
scaling to [0, 1], model, softmax. The model is made once in each Python worker and kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from . import recursive, signal

#: A model gives a score for each class of each window, from features (windows, components, frequencies, times).
Model = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Chain:
    """What is done to windows before the model sees them."""

    low: float = 1.0
    high: float = 20.0
    order: int = 4
    taper: float = 0.1
    target: float = 50.0
    nperseg: int = 256

    def before(self, x: np.ndarray, rate: float) -> np.ndarray:
        """``x``: windows, components, samples."""
        windows, parts, n = x.shape
        at = np.arange(n) - (n - 1) / 2
        slope = (x * at).sum(-1, keepdims=True) / max((at * at).sum(), 1e-300)
        x = x - x.mean(-1, keepdims=True) - slope * at
        x = x * tukey(n, self.taper)
        x = recursive.filtered(x.reshape(windows * parts, n), rate, self.low, self.high, self.order)
        x = np.stack([signal.resampled(row, rate, self.target) for row in x]).reshape(windows, parts, -1) if self.target != rate else x.reshape(windows, parts, n)
        x = x / (np.abs(x.reshape(windows, -1)).std(1, ddof=1) + 1e-10)[:, None, None]
        power = np.stack([[signal.spectrogram(row, self.target, self.nperseg) for row in rows] for rows in x])
        if not power.shape[-1]:
            raise ValueError(f"windows of {n} samples at {rate} Hz are shorter than a spectrogram's {self.nperseg} at {self.target} Hz")
        low, high = power.min((2, 3), keepdims=True), power.max((2, 3), keepdims=True)
        return (power - low) / (high - low + 1e-10)


def tukey(n: int, share: float) -> np.ndarray:
    """Cosine ends over ``share`` of the samples, half of it at each end."""
    if n < 2 or share <= 0:
        return np.ones(n)
    edge = np.minimum(np.arange(n), n - 1 - np.arange(n)) / (share * (n - 1) / 2)
    return np.where(edge < 1, (1 - np.cos(np.pi * np.minimum(edge, 1))) / 2, 1.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def energy_model(classes: int, sharpness: float = 4.0) -> Callable[[], Model]:
    """A deterministic default: each class is a part of the frequencies, scored by its mean."""

    def make() -> Model:
        return lambda x: np.stack([sharpness * part.mean((1, 2, 3)) for part in np.array_split(x, classes, axis=2)], 1)

    return make


_models: dict[str, Model] = {}


def model_of(name: str, make: Callable[[], Model]) -> Model:
    """One model of a name for each Python worker."""
    if name not in _models:
        _models[name] = make()
    return _models[name]


def grouped(windows: DataFrame, keys: list[str], components: list[str], samples: str = "window") -> DataFrame:
    """A row for each of ``keys`` that has all components: their arrays in order. Of repeated ones the largest stays."""
    each = [F.max(F.when(F.col("component") == c, C.doubles(F.col(samples)))) for c in components]
    found = windows.groupBy(*keys, "rate_hz").agg(F.array(*each).alias(samples))
    same = F.size(F.array_distinct(F.transform(samples, lambda x: F.size(x)))) == 1
    return found.where(~F.exists(samples, lambda x: x.isNull()) & same & (F.size(F.get(samples, F.lit(0))) > 1))


def classified(windows: DataFrame, name: str, make: Callable[[], Model], chain: Chain, classes: list[str] = C.CLASS_ORDER, samples: str = "window") -> DataFrame:
    """Add a probability for each class; the windows' samples are dropped."""
    kept = [f for f in windows.schema.fields if f.name != samples and f.name not in classes]
    schema = T.StructType([*kept, *(T.StructField(c, T.DoubleType()) for c in classes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(name, make)
        for batch in batches:
            values, rates = batch.column(samples).to_pylist(), batch.column("rate_hz").to_pylist()
            out = np.zeros((len(values), len(classes)))
            shapes: dict[tuple, list[int]] = {}
            for i, (v, r) in enumerate(zip(values, rates)):
                shapes.setdefault((len(v), len(v[0]), r), []).append(i)
            for (_, _, rate), at in shapes.items():
                x = np.array([values[i] for i in at], float)
                out[at] = softmax(model(chain.before(np.nan_to_num(x), rate)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(c) for c in out.T)], names=[f.name for f in schema.fields])

    return windows.mapInArrow(run, schema)
