"""Recursive Butterworth filters, run forward and backward, over blocks of traces.

The filter is a chain of second-order sections from the bilinear transform. A section is run over blocks of samples by
matrix products: each block's answer from rest, plus what the state at its begin adds; only the states go from block to
block in a loop. Traces are extended at both ends by their own point reflection, and states begin as if the first
sample had always been there, so there is no wrap around and little of a transient.
"""

from __future__ import annotations

import cmath
import math

import numpy as np
from pyspark.sql import DataFrame

from .signal import map_samples

BLOCK = 128


def butterworth(order: int, rate: float, low: float | None = None, high: float | None = None) -> np.ndarray:
    """Second-order sections (b0, b1, b2, 1, a1, a2) of a band-pass, or a high-pass or low-pass with one corner."""
    warped = lambda f: 2 * rate * math.tan(math.pi * f / rate)
    poles = [cmath.exp(1j * math.pi * (2 * k + order + 1) / (2 * order)) for k in range(order)]
    if low and high:
        w1, w2 = warped(low), warped(high)
        half, centre = (w2 - w1) / 2, w1 * w2
        analog = [p * half + s * cmath.sqrt((p * half) ** 2 - centre) for p in poles for s in (1, -1)]
        zeros, at = [1.0] * order + [-1.0] * order, 2 * math.atan(math.sqrt(centre) / (2 * rate))
    elif low:
        analog, zeros, at = [warped(low) / p for p in poles], [1.0] * order, math.pi
    else:
        analog, zeros, at = [warped(high) * p for p in poles], [-1.0] * order, 0.0
    digital = [(2 * rate + s) / (2 * rate - s) for s in analog]
    pairs = [(z, z.conjugate()) for z in digital if z.imag > 1e-12]
    alone = sorted((z.real for z in digital if abs(z.imag) <= 1e-12), reverse=True)
    pairs += [tuple(alone[i : i + 2]) for i in range(0, len(alone), 2)]
    pairs.sort(key=lambda p: max(abs(z) for z in p))
    # A zero at either end for each pole, of both kinds in a section where the filter has both.
    ones, others = [z for z in zeros if z > 0], [z for z in zeros if z < 0]
    sections = []
    for pair in pairs:
        own = []
        for _ in pair:
            own.append((ones if len(ones) > len(others) or (ones and not own) else others or ones).pop())
        b = np.poly(own) if len(own) == 2 else np.array([1.0, -own[0], 0.0])
        a = np.array([1.0, -sum(pair).real if len(pair) == 2 else -pair[0], (pair[0] * pair[1]).real if len(pair) == 2 else 0.0])
        sections.append([*b, *a])
    sos = np.array(sections, float)
    z = cmath.exp(1j * at)
    powers = np.array([1, 1 / z, 1 / z**2])
    sos[0, :3] /= abs(np.prod((sos[:, :3] @ powers) / (sos[:, 3:] @ powers)))
    return sos


def steady(sos: np.ndarray) -> np.ndarray:
    """The state of each section once a constant 1 has passed for long."""
    out, level = np.zeros((len(sos), 2)), 1.0
    for i, (b0, b1, b2, _, a1, a2) in enumerate(sos):
        gain = (b0 + b1 + b2) / (1 + a1 + a2)
        second = b2 - a2 * gain
        out[i] = level * (b1 - a1 * gain + second), level * second
        level *= gain
    return out


def through(section: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """A section over the rows of ``x``, from the rows of ``state``."""
    b0, b1, b2, _, a1, a2 = section
    step = np.array([[-a1, 1.0], [-a2, 0.0]])
    into = np.array([b1 - a1 * b0, b2 - a2 * b0])
    powers = [np.eye(2)]
    for _ in range(BLOCK):
        powers.append(step @ powers[-1])
    seen = np.array([p[0] for p in powers[:BLOCK]])  # what a state adds to each sample of a block
    answer = np.concatenate([[b0], [p[0] @ into for p in powers[: BLOCK - 1]]])
    reach = np.subtract.outer(np.arange(BLOCK), np.arange(BLOCK))
    matrix = np.where(reach >= 0, answer[np.maximum(reach, 0)], 0.0)
    left = np.array([powers[BLOCK - 1 - j] @ into for j in range(BLOCK)])  # what each sample leaves in the state
    rows, n = x.shape
    padded = np.pad(x, ((0, 0), (0, -n % BLOCK))).reshape(rows, -1, BLOCK)
    out, added = padded @ matrix.T, padded @ left
    for k in range(padded.shape[1]):
        out[:, k] += state @ seen.T
        state = state @ powers[BLOCK].T + added[:, k]
    return out.reshape(rows, -1)[:, :n]


def forward_backward(sos: np.ndarray, x: np.ndarray, pad: int) -> np.ndarray:
    """Rows of ``x`` filtered in both directions, after extending them by ``pad`` samples (fewer if they are short)."""
    x = np.atleast_2d(np.asarray(x, float))
    n = x.shape[1]
    if n == 0:
        return x
    pad = min(pad, n - 1)
    y = np.concatenate([2 * x[:, :1] - x[:, pad:0:-1], x, 2 * x[:, -1:] - x[:, -2 : -pad - 2 : -1]], 1)
    first = steady(sos)
    for _ in range(2):
        begin = y[:, :1].copy()
        for section, state in zip(sos, first):
            y = through(section, y, begin * state)
        y = y[:, ::-1]
    return y[:, pad : pad + n]


def filtered(x: np.ndarray, rate: float, low: float | None, high: float | None, order: int = 4) -> np.ndarray:
    """Rows of one rate through a zero-phase Butterworth filter; ends are extended by three times its length."""
    taps = order * (2 if low and high else 1) + 1
    return forward_backward(butterworth(order, rate, low, high), x, 3 * taps)


def band_pass(traces: DataFrame, low: float, high: float, order: int = 4, **names: str) -> DataFrame:
    return map_samples(traces, lambda x, r: filtered(x, r, low, high, order)[0], **names)


def high_pass(traces: DataFrame, low: float, order: int = 4, **names: str) -> DataFrame:
    return map_samples(traces, lambda x, r: filtered(x, r, low, None, order)[0], **names)
