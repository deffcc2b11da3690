import datetime
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickspark.functions import columns as C
from pickspark.operators import associate, catalog, joins, matching, quality, quantiles, scoring, signal
from pickspark.plans import planning
from pickspark.sources import readers, writers
from pickspark.streaming import ingest


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


CHANNELS = [
    (["HH", "BH", "HN", "LH"], "HH"),
    (["BH", "LH", "VH"], "BH"),
    (["DP"], "DP"),
    (["EP", "DP"], "EP"),
    (["LH", "VH", "UH"], None),
    ([], None),
    (["HN", "EH"], "EH"),
    (["EH", "HN"], "EH"),
    ([" HH ", "HH", "BH"], "HH"),
    (["BH", "HN"], "HN"),
]


@pytest.mark.parametrize("channels, best", CHANNELS)
def test_best_band(spark, channels, best):
    df = spark.createDataFrame([(channels,)], "c array<string>")
    assert df.select(C.best_band(F.col("c"))).first()[0] == best


def test_band_order():
    at = C.BAND_PRIORITY.index
    assert all(at(fast) < at(other) for fast in ("HH", "EH", "EP", "EL", "HN") for other in ("SH", "SL", "BH", "DP", "CN"))
    assert at("SH") < at("BH") < at("DP") and at("HH") < at("EP") < at("EL") < at("HN")
    assert len(C.BAND_PRIORITY) == len(set(C.BAND_PRIORITY)) == 10


def brute_match(ref, cand, tol):
    used, out = set(), []
    for t in sorted(ref):
        best = None
        for i, c in enumerate(sorted(cand)):
            d = abs(c - t)
            if i not in used and d <= tol and (best is None or d < best[0]):
                best = (d, i)
        if best:
            used.add(best[1])
        out.append(best[0] if best else None)
    return sum(o is not None for o in out), len(cand) - len(used)


def test_match_equals_brute_force(spark):
    rng = random.Random(4)
    ref = [(f"s{k % 3}", at(rng.randrange(0, 600)), k) for k in range(150)]
    cand = [(f"s{k % 3}", at(rng.randrange(0, 600)), k) for k in range(200)]
    r = spark.createDataFrame(ref, "tid string, time timestamp_ntz, arrival_id long")
    c = spark.createDataFrame(cand, "tid string, peak timestamp_ntz, pick_id long")
    rows = matching.match(r, c, ["tid"], 5.0).collect()
    assert len({x.pick_id for x in rows if x.pick_id is not None}) == sum(x.pick_id is not None for x in rows)
    for s in ("s0", "s1", "s2"):
        own = [x for x in rows if x.tid == s]
        seconds = lambda part: [(x[1] - at(0)).total_seconds() for x in part if x[0] == s]
        hits = sum(x.arrival_id is not None and x.pick_id is not None for x in own)
        assert (hits, sum(x.arrival_id is None for x in own)) == brute_match(seconds(ref), seconds(cand), 5.0)


def test_suppress_is_idempotent(spark):
    rng = random.Random(5)
    picks = spark.createDataFrame([("a", at(rng.randrange(0, 300)), k, k % 2) for k in range(100)], "tid string, peak timestamp_ntz, pick_id long, priority int")
    once = matching.suppress(picks, ["tid"], 3.0, "priority")
    kept = sorted(x.peak for x in once.collect())
    assert all((b - a).total_seconds() > 3 for a, b in zip(kept, kept[1:]))
    assert matching.suppress(once, ["tid"], 3.0, "priority").count() == len(kept)


def test_filters_in_frequency():
    t = np.arange(4000) / 100
    slow, fast = np.sin(2 * np.pi * 0.2 * t), np.sin(2 * np.pi * 5 * t)
    out = signal.filtered(slow + fast, 100, 1, 20)
    assert np.abs(out - fast)[200:-200].max() < 0.02
    assert np.allclose(signal.resampled(np.ones(50), 100, 50), 1)
    assert len(signal.resampled(np.ones(50), 100, 37)) == 18 and len(signal.resampled(np.ones(1), 100, 50)) == 0


def test_spectrogram_power():
    t = np.arange(6400) / 100
    power = signal.spectrogram(np.sin(2 * np.pi * 12.5 * t), 100, 256)
    assert power.mean(1).argmax() == 32
    assert abs(power.sum(0).mean() * 100 / 256 - 0.5) < 0.01


def test_wood_anderson_gain():
    # Over velocity: 2080 far above the corner at 1.25 Hz after one integration; at the corner 2080 / (1.4 w0).
    w0 = 2 * np.pi / 0.8
    at = lambda f: abs(signal.paz(np.array([f]), **signal.WOOD_ANDERSON)[0])
    assert at(1.25) == pytest.approx(2080 / (2 * 0.7 * w0), rel=1e-3)
    assert at(50.0) == pytest.approx(2080 / (2 * np.pi * 50), rel=1e-2) and at(1.0) == pytest.approx(180, rel=0.01) and at(10.0) == pytest.approx(33, rel=0.02)


def test_wood_anderson_inverts_its_own_response():
    rng = np.random.default_rng(1)
    f = np.fft.rfftfreq(4096, 0.01)
    x = np.fft.irfft(np.fft.rfft(rng.normal(size=4096)) * ((f > 1) & (f < 30)), 4096)
    w = signal.WOOD_ANDERSON
    assert np.allclose(signal.wood_anderson(x, 100, w["poles"], w["zeros"], w["gain"], water=200), x, atol=1e-3)


def test_detrended_ramp_is_zero(spark):
    df = spark.createDataFrame([([float(3 * i + 2) for i in range(50)],)], "x array<double>")
    assert max(map(abs, df.select(C.detrend(F.col("x"))).first()[0])) < 1e-9


def test_curve_runs(spark):
    df = spark.createDataFrame([("t", [0.1, 0.5, 0.9, 0.5, 0.1, 0.6, 0.6])], "id string, P array<double>")
    rows = sorted(tuple(r) for r in scoring.picks_from_curves(df, ["id"], {"P": 0.5}).collect())
    assert rows == [("t", "P", 1, 2, 3, 0.9), ("t", "P", 5, 5, 6, 0.6)]


def test_progress_counts(spark):
    units = spark.range(50).select(F.format_string("s%04d", "id").alias("shard_id"))
    done = units.limit(20)
    claims = units.select("shard_id", F.lit(at(0)).cast("timestamp_ntz").alias("claimed"))
    row = catalog.progress(units, claims, done, F.lit(at(9 * 3600)).cast("timestamp_ntz"), 8.0).first()
    assert (row.total, row.complete, row.remaining, row.stale) == (50, 20, 30, 30)


def test_plan_ids_depend_on_content(spark):
    rows = [("A.S1.", "2024.001", "2024.366"), ("A.S2.", None, None), ("A.S3.", "2023.001", "2023.100")]
    stations = spark.createDataFrame(rows, "id string, start_date string, end_date string")
    days = (datetime.date(2024, 1, 1), datetime.date(2024, 2, 1))
    one, two = (sorted(map(str, planning.plan(s, *days).collect())) for s in (stations, stations.orderBy(F.desc("id"))))
    assert one == two
    total = planning.plan(stations, *days).agg(F.sum("n_station_days")).first()[0]
    assert total == 62


def test_checks_report_null_and_nan_apart(spark):
    t = at(0)
    rows = [("a", "HH", "P", t, t, t, 0.5, None, "r"), ("a", "HH", "X", t, t, t, 1.5, float("nan"), None)]
    picks = spark.createDataFrame(rows, "tid string, cha string, pha string, start_ts timestamp_ntz, peak timestamp_ntz, end_ts timestamp_ntz, conf double, amp double, rid string")
    got = {r.check: r.offending for r in quality.pick_checks(picks).collect()}
    assert got == {"conf_range": 1, "phase_known": 1, "peak_in_window": 0, "amp_null": 1, "amp_nan": 1, "fields_present": 1}


def test_left_range_join_keeps_rows_with_nulls_and_copies(spark):
    left = spark.createDataFrame([(1, "a", "P", at(0)), (1, "a", "P", at(0)), (2, None, "P", at(0)), (3, "a", "P", at(900))], "event_id int, tid string, pha string, expected_at timestamp_ntz")
    picks = spark.createDataFrame([("a", "P", at(1), 0.5, 1), ("a", "P", at(2), 0.9, 2)], "tid string, pha string, peak timestamp_ntz, conf double, pick_id long")
    got = sorted((r.event_id, r.n_picks, r.conf, r.dt) for r in joins.best_in_window(left, picks, 5.0).collect())
    assert got == [(1, 2, 0.9, 2.0), (1, 2, 0.9, 2.0), (2, 0, 0.0, None), (3, 0, 0.0, None)]
    assert joins.range_join(left, picks, ["tid", "pha"], "expected_at", "peak", 5.0, 5.0, "left").count() == 2 * 2 + 2


def test_travel_table_meets_all_near_stations(spark):
    rng = random.Random(9)
    places = [(f"s{i}", rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(300)] + [("e", 10.0, 179.9), ("w", 10.0, -179.9), ("n", 89.5, 0.0), ("o", 89.5, 180.0)]
    stations = spark.createDataFrame(places, "id string, latitude double, longitude double")
    cells = spark.createDataFrame([(i, y, x, 10.0) for i, (_, y, x) in enumerate(places)], "cell int, lat double, lon double, depth double")
    got = {(r.tid, r.cell) for r in associate.travel_table(stations, cells, 150.0, 6.0, 1.75).where("pha = 'P'").collect()}

    def km(a, b):
        h = np.radians([(a[1] - b[1]) / 2, (a[2] - b[2]) / 2])
        return 2 * 6371 * np.arcsin(np.sqrt(np.sin(h[0]) ** 2 + np.cos(np.radians(a[1])) * np.cos(np.radians(b[1])) * np.sin(h[1]) ** 2))

    assert got == {(a[0], i) for a in places for i, b in enumerate(places) if km(a, b) <= 150}


def test_endless_islands_hold_a_few_rows():
    rng = np.random.default_rng(8)
    tol, n = 1.0, 20_000
    times = np.sort(rng.uniform(0, n / 3, n)).tolist()  # three a second: no gap is longer than the tolerance for long
    side = rng.integers(0, 2, n).tolist()
    m, got = matching.Matching(tol), []
    for i, (t, s) in enumerate(zip(times, side)):
        got += m.push(t, i, s)
    got += m.end()
    ref, cand, want, used = [i for i in range(n) if side[i] == 0], [i for i in range(n) if side[i]], {}, set()
    cand_times = np.array([times[c] for c in cand])
    for i in ref:
        lo, hi = np.searchsorted(cand_times, [times[i] - tol - 1e-9, times[i] + tol + 1e-9])
        free = [c for c in cand[lo:hi] if c not in used and abs(times[c] - times[i]) <= tol]
        want[i] = min(free, key=lambda c: (abs(times[c] - times[i]), c), default=None)
        used.add(want[i])
    assert {a: b for a, b, _ in got if a is not None} == want
    assert sorted(b for a, b, _ in got if a is None) == sorted(set(cand) - used)
    assert m.peak < 60

    priority = rng.integers(0, 3, n).tolist()
    s, ids = matching.Suppression(tol), []
    for i, t in enumerate(times):
        ids += s.push(t, priority[i], i)
    ids += s.end()
    kept = []
    for i in sorted(range(n), key=lambda i: (priority[i], times[i], i)):
        at = np.searchsorted(kept, times[i])
        if not any(abs(kept[j] - times[i]) <= tol for j in (at - 1, at) if 0 <= j < len(kept)):
            kept.insert(at, times[i])
    assert sorted(times[i] for (i,) in ids) == kept and s.peak < 100


def test_merged_segments(spark):
    rows = [("a", 2, [1.0, 2.0]), ("a", 6, [5.0, 6.0, 7.0]), ("a", 3, [9.0, 3.0]), ("b", 0, [4.0])]
    got = {r.id: r.samples for r in signal.merged(spark.createDataFrame(rows, "id string, offset int, samples array<double>"), ["id"], 8).collect()}
    assert got == {"a": [0, 0, 1, 2, 3, 0, 5, 6], "b": [4, 0, 0, 0, 0, 0, 0, 0]}


def test_quartiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=5001), 2)
    df = spark.createDataFrame([(float(v), None) for v in x] + [(float("nan"), None)], "a double, b double")
    got = {r.column: r for r in catalog.distribution(df, ["a", "b"], accuracy=200).collect()}
    assert (got["a"].q1, got["a"].median, got["a"].q3) == pytest.approx(tuple(np.quantile(x, [0.25, 0.5, 0.75]))) and got["a"].n == 5001
    assert got["b"].n == 0 and got["b"].median is None


def pick_rows(spark, n, tid="N1.A."):
    rows = [(tid, "HH", "P", at(60 * i), at(60 * i + 1), at(60 * i + 2), 0.5, 1.0, 1.0, "r") for i in range(n)]
    return spark.createDataFrame(rows, "tid string, cha string, pha string, start_ts timestamp_ntz, peak timestamp_ntz, end_ts timestamp_ntz, conf double, amp double, amp_raw double, rid string")


def test_replayed_batch_changes_nothing(spark, tmp_path):
    sink = ingest.picks_then_coverage(str(tmp_path / "picks"), str(tmp_path / "coverage"))
    sink(pick_rows(spark, 10), 0)
    sink(pick_rows(spark, 12), 1)
    sink(pick_rows(spark, 12), 1)
    spark.catalog.refreshByPath(str(tmp_path / "picks"))
    assert readers.picks(spark, str(tmp_path / "picks")).count() == 12
    assert [r.npks for r in readers.coverage(spark, str(tmp_path / "coverage")).collect()] == [12]


def test_lists_and_manifests(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# comment\nB.2., x\nA.1.\nB.2.\n\n")
    assert [r.id for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["A.1.", "B.2."]
    (tmp_path / "networks.json").write_text(json.dumps({"east": ["A", "B"], "west": ["C"]}))
    assert readers.network_list(spark, str(tmp_path / "networks.json")).count() == 3
    for i in range(3):
        files = [{"kind": "picks", "path": f"p{i}", "rows": 5, "network": "A", "year": 2024, "month": 1}]
        (tmp_path / f"m{i}.manifest").write_text(json.dumps({"job_id": f"j{i}", "run_id": "r", "n_picks": 5, "files": files, "records": [{"tid": "A.1.", "cha": "HH", "yr": 2024, "doy": 1, "npks": 5, "nclfs": 0}]}, indent=1))
    table = readers.manifests(spark, str(tmp_path / "*.manifest"))
    assert readers.manifest_files(table).count() == 3 and readers.manifest_coverage(table).agg(F.sum("npks")).first()[0] == 15
    assert catalog.manifest_totals(table).first().n_rows == 5


def test_plan_refuses_to_overwrite(spark, tmp_path):
    stations = spark.createDataFrame([("A.S1.", None, None)], "id string, start_date string, end_date string")
    plan = planning.plan(stations, datetime.date(2024, 1, 1), datetime.date(2024, 1, 5))
    writers.write_units(plan, str(tmp_path / "units"))
    with pytest.raises(Exception, match="exist"):
        writers.write_units(plan, str(tmp_path / "units"))
    assert readers.units(spark, str(tmp_path / "units")).first().n_station_days == 4


def test_station_groups_over_several_ranges(spark):
    ids = [f"N{i % 7}.S{i:04d}" for i in range(1000)]
    stations = spark.createDataFrame([(x,) for x in [*ids, None, ids[5]]], "id string")
    got = planning.grouped_stations(stations, 40, 100)
    want = [(x, k // 40) for k, x in enumerate([None, *sorted([*ids, ids[5]])])]
    assert sorted(((r.id, r.station_group) for r in got.collect()), key=lambda r: (r[0] or "", r[1])) == want
    # No task sorts all stations.
    alone = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in line and "row_number" in line]
    assert alone and all("[_range" in line for line in alone)


def test_no_model_is_left_out(spark):
    windows, models = spark.range(2), lambda n: spark.range(n).select(F.col("id").alias("weight"))
    assert scoring.at_weights(windows, models(scoring.MOST_MODELS)).count() == 2 * scoring.MOST_MODELS
    with pytest.raises(ValueError):
        scoring.at_weights(windows, models(scoring.MOST_MODELS + 1))


def test_grouped_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(11)
    rows = [(k, float(v)) for k, n in (("big", 30_000), ("ties", 5_000), ("small", 7), ("one", 1), (None, 4)) for v in (rng.normal(size=n) if k != "ties" else rng.integers(0, 3, n))]
    rows += [("big", None), ("big", float("nan")), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: tuple(r)[1:] for r in quantiles.quantiles(df, ["k"], "x", {"a": 0.1, "m": 0.5, "z": 0.93}).collect()}
    for k in ("big", "ties", "small", "one", None):
        x = [v for q, v in rows if q == k and v is not None and v == v]
        assert got[k] == pytest.approx(tuple(np.quantile(x, [0.1, 0.5, 0.93]))), k
    assert "nothing" not in got
    # No aggregate holds the values of a group.
    assert "percentile(" not in quantiles.quantiles(df, ["k"], "x", {"m": 0.5})._jdf.queryExecution().optimizedPlan().toString()


def test_object_names_of_all_layouts(spark):
    names = ["2019/2019_187/CICLC__HHZ___2019187.ms", "CISRT__HNE01_2019001.ms", "CLC.CI.HHZ..D.2019.187", "x/CLC.CI.HHZ.00.D.2019.187", "CI/2019/187/CLC.CI.2019.187#9", "CLC.CI.2019.187#10", "CLC.CI.2019.188#x", "index.html", "CLC.CI.2019.187", "", None]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r.path: tuple(r)[1:] for r in readers.objects(df).collect()}
    assert got == {
        names[0]: ("padded", "CI", "CLC", "HHZ", "", 2019, 187, None),
        names[1]: ("padded", "CI", "SRT", "HNE", "01", 2019, 1, None),
        names[2]: ("dotted", "CI", "CLC", "HHZ", "", 2019, 187, None),
        names[3]: ("dotted", "CI", "CLC", "HHZ", "00", 2019, 187, None),
        names[4]: ("versioned", "CI", "CLC", None, None, 2019, 187, 9),
        names[5]: ("versioned", "CI", "CLC", None, None, 2019, 187, 10),
    }
    newest = readers.newest_versions(readers.objects(df)).collect()
    assert [(r.path, r.version, r.versions) for r in newest] == [(names[5], 10, 2)]
