import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickspark import queries
from pickspark.functions import columns as C
from pickspark.operators import classify, recursive
from pickspark.plans.fixtures import Views


def plain_filter(sos, x, pad):
    """Sample by sample, forward and backward."""
    n = len(x)
    pad = min(pad, n - 1)
    y = [2 * x[0] - x[i] for i in range(pad, 0, -1)] + list(x) + [2 * x[-1] - x[n - 1 - i] for i in range(1, pad + 1)]
    for _ in range(2):
        begin, level = y[0], 1.0
        for b0, b1, b2, _, a1, a2 in sos:
            gain = (b0 + b1 + b2) / (1 + a1 + a2)
            z2 = level * begin * (b2 - a2 * gain)
            z1 = level * begin * (b1 - a1 * gain) + z2
            level *= gain
            out = []
            for v in y:
                w = b0 * v + z1
                z1, z2 = b1 * v - a1 * w + z2, b2 * v - a2 * w
                out.append(w)
            y = out
        y = y[::-1]
    return np.array(y[pad : pad + n])


@pytest.mark.parametrize("order", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("low, high", [(1.0, 20.0), (0.5, None), (None, 10.0)])
def test_filter_equals_a_plain_loop(order, low, high):
    rng = np.random.default_rng(order)
    sos = recursive.butterworth(order, 50.0, low, high)
    taps = order * (2 if low and high else 1) + 1
    for n in (1, 2, 30, 128, 500, 1301):
        x = rng.normal(size=(2, n)) + 3
        want = np.array([plain_filter(sos, row, 3 * taps) for row in x])
        assert np.abs(recursive.filtered(x, 50.0, low, high, order) - want).max() < 1e-9
    # The gain is Butterworth's, at warped frequencies.
    f = np.array([0.01, 1, 5, 10, 20, 24.9])
    z, t = np.exp(-2j * np.pi * f / 50), np.tan(np.pi * f / 50)
    gain = np.abs(np.prod([(s[0] + s[1] * z + s[2] * z * z) / (1 + s[4] * z + s[5] * z * z) for s in sos], 0))
    a, b = (np.tan(np.pi * (c or 1) / 50) for c in (low, high))
    ratio = (t * t - a * b) / (t * (b - a)) if low and high else a / t if low else t / b
    assert np.abs(gain - 1 / np.sqrt(1 + ratio ** (2 * order))).max() < 1e-9


def test_a_constant_passes_or_goes_at_once():
    x = np.full((1, 200), 7.0)
    assert np.abs(recursive.filtered(x, 50.0, None, 5.0) - 7).max() < 1e-9
    assert np.abs(recursive.filtered(x, 50.0, 1.0, 5.0)).max() < 1e-9
    assert recursive.filtered(np.zeros((1, 0)), 50.0, 1.0, 5.0).shape == (1, 0)


def plain_chain(parts, rate, c):
    """Probabilities of one window, value by value."""
    done = []
    for x in parts:
        n = len(x)
        mid = (n - 1) / 2
        mean, slope = sum(x) / n, sum(v * (i - mid) for i, v in enumerate(x)) / sum((i - mid) ** 2 for i in range(n))
        x = [v - mean - slope * (i - mid) for i, v in enumerate(x)]
        wide = c.taper * (n - 1) / 2
        x = [v * ((1 - math.cos(math.pi * min(i, n - 1 - i) / wide)) / 2 if min(i, n - 1 - i) < wide else 1) for i, v in enumerate(x)]
        x = plain_filter(recursive.butterworth(c.order, rate, c.low, c.high), x, 3 * (2 * c.order + 1))
        new = []
        for k in range(int(n * c.target / rate)):
            at = min(max((k + 0.5) * rate / c.target - 0.5, 0), n - 1)
            i = min(int(at), n - 2)
            new.append(x[i] + (at - i) * (x[i + 1] - x[i]))
        done.append(new)
    size = [abs(v) for x in done for v in x]
    m = sum(size) / len(size)
    deviation = math.sqrt(sum((v - m) ** 2 for v in size) / (len(size) - 1)) + 1e-10
    energy = np.zeros(4)
    for x in done:
        power = []
        for begin in range(0, len(x) - c.nperseg + 1, c.nperseg // 2):
            part = [v / deviation for v in x[begin : begin + c.nperseg]]
            m = sum(part) / len(part)
            hann = [0.5 - 0.5 * math.cos(2 * math.pi * i / c.nperseg) for i in range(c.nperseg)]
            part = [(v - m) * h for v, h in zip(part, hann)]
            column = []
            for k in range(c.nperseg // 2 + 1):
                z = sum(v * complex(math.cos(2 * math.pi * k * i / c.nperseg), -math.sin(2 * math.pi * k * i / c.nperseg)) for i, v in enumerate(part))
                column.append(abs(z) ** 2 / (c.target * sum(h * h for h in hann)) * (2 if 0 < k < c.nperseg // 2 else 1))
            power.append(column)
        flat = [v for column in power for v in column]
        low, high = min(flat), max(flat)
        bands = np.array_split(np.array([[(v - low) / (high - low + 1e-10) for v in column] for column in power]).T, 4)
        energy += [b.mean() / 3 for b in bands]
    powers = np.exp(4 * energy - (4 * energy).max())
    return powers / powers.sum()


def test_chain_equals_plain_steps(spark):
    v = Views(spark, "/root/testdata/sf0.001")
    windows = queries.j03_windows(v).where("block < 2")
    rows = windows.collect()
    assert len(rows) > 50 and {r.offset for r in rows} == {0, 16}
    got = {(r.station_no, r.block, r.offset): tuple(r[c] for c in C.CLASS_ORDER) for r in classify.classified(windows, "energy-4", classify.energy_model(4), queries.J3_CHAIN).collect()}
    assert len(got) == len(rows)
    for r in rows[:60]:
        assert got[r.station_no, r.block, r.offset] == pytest.approx(plain_chain(r.window, r.rate_hz, queries.J3_CHAIN), abs=1e-9)


def test_job_reports_the_likeliest_class_without_noise(spark):
    v = Views(spark, "/root/testdata/sf0.001")
    found = classify.classified(queries.j03_windows(v), "energy-4", classify.energy_model(4), queries.J3_CHAIN).collect()
    label = lambda r: max(C.CLASS_ORDER, key=lambda c: (r[c], -C.CLASS_ORDER.index(c)))
    want = {}
    for r in found:
        if label(r) != "no":
            want.setdefault((r.station_no, label(r)), []).append(r.eq)
    from pickspark import registry

    got = {(r.station_no, r.label): (r.n, r.eq) for r in registry.QUERIES["j03_classification_job"](spark, v.dir).collect()}
    assert got == {k: (len(x), pytest.approx(sum(x) / len(x), abs=2e-6)) for k, x in want.items()}


def test_incomplete_and_uneven_groups_are_left_out(spark):
    rows = [("a", c, 1.0, [1.0, 2.0, 3.0]) for c in "ZNE"] + [("b", c, 1.0, [1.0, 2.0]) for c in "ZN"] + [("c", c, 1.0, [1.0] * (3 + (c == "E"))) for c in "ZNE"] + [("d", c, 1.0, None if c == "N" else [1.0, 2.0]) for c in "ZNE"]
    df = spark.createDataFrame(rows, "k string, component string, rate_hz double, window array<double>")
    assert [r.k for r in classify.grouped(df, ["k"], ["Z", "N", "E"]).collect()] == ["a"]


def test_model_is_made_once_a_worker(spark, tmp_path):
    made = str(tmp_path / "made")

    def make():
        with open(made, "a") as f:
            f.write("x")
        return classify.energy_model(4)()

    rows = [(i, 1.0, [[float((i * j) % 7 + k) for j in range(48)] for k in range(3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, rate_hz double, window array<array<double>>").coalesce(1)
    for _ in range(3):
        assert classify.classified(df, "counted", make, queries.J3_CHAIN).agg(F.count("*")).first()[0] == 40
    assert len(open(made).read()) <= 4
