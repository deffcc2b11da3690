import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickspark import schemas
from pickspark.operators import joins, travel
from pickspark.sources import readers
from pickspark.streaming import ingest

T0 = datetime.datetime(2024, 1, 1)
FILE = "tid string, cha string, pha string, peak timestamp_ntz"


def at(hours):
    return T0 + datetime.timedelta(hours=hours)


def test_closed_days_late_and_too_late_rows(spark, tmp_path):
    """Files come one at a time; a day is written when the watermark of six hours has passed it, once."""
    source, batches = tmp_path / "in", [
        [("A.", h) for h in (1, 5, 20)],
        [("A.", 23.5), ("A.", 26), ("B.", 15)],  # late, but within six hours of the last file: they count
        [("A.", 29.5)],
        [("A.", 40)],  # closes day one of both stations
        [("A.", 3), ("B.", 4), ("A.", 41)],  # too late, but the last
        [("C.", 100)],  # closes day two, which has kept what came before
    ]
    source.mkdir()
    dropped, rows = [], []
    for n, batch in enumerate(batches):
        with open(source / f"{n}.json", "w") as f:
            for tid, h in batch:
                f.write(json.dumps({"tid": tid, "cha": "HH", "pha": "P", "peak": at(h).isoformat()}) + "\n")
        stream = spark.readStream.schema(FILE).json(str(source))
        job = ingest.coverage_of_closed_days(stream, str(tmp_path / "coverage"), str(tmp_path / "progress"), "6 hours")
        job.awaitTermination()
        last = [p for p in job.recentProgress if p["stateOperators"]]
        dropped.append(sum(s["numRowsDroppedByWatermark"] for p in last for s in p["stateOperators"]))
        rows.append(max((s["numRowsTotal"] for s in last[-1]["stateOperators"]), default=0) if last else 0)
    got = {(r.tid, r.doy): r.npks for r in readers.coverage(spark, str(tmp_path / "coverage")).collect()}
    assert got == {("A.", 1): 4, ("B.", 1): 1, ("A.", 2): 4}
    assert dropped[:4] == [0, 0, 0, 0] and dropped[4] >= 2
    assert rows[-1] < max(rows)  # the state of closed days is gone
    # No day is written twice.
    files = spark.read.schema(f"{schemas.COVERAGE}, batch long").option("basePath", str(tmp_path / "coverage")).parquet(str(tmp_path / "coverage"))
    assert files.count() == 3


def test_outer_range_join_keeps_each_row_once(spark):
    rng = np.random.default_rng(3)
    left = [("k" + str(i % 4) if i % 11 else None, i if i % 7 else None, at(float(rng.uniform(0, 50))) if i % 13 else None) for i in range(120)]
    left += left[:15]  # repeated rows
    right = [("k" + str(i % 5), at(float(rng.uniform(0, 50))), i) for i in range(60)]
    l, r = spark.createDataFrame(left, "k string, a long, t timestamp_ntz"), spark.createDataFrame(right, "k string, u timestamp_ntz, b long")  # noqa: E741
    joined = joins.range_join(l, r, ["k"], "t", "u", 3600.0, 7200.0, "left")
    got = sorted(((x.k, x.a, x.t, x.b) for x in joined.collect()), key=str)
    want = []
    for k, a, t in left:
        near = [b for q, u, b in right if q == k and t is not None and -3600 <= (u - t).total_seconds() <= 7200]
        want += [(k, a, t, b) for b in near] or [(k, a, t, None)]
    assert got == sorted(want, key=str)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1  # planned once


def test_layered_times(spark):
    # One layer: a straight line.
    km, z = np.array([0.0, 5.0, 40.0, 40.0]), np.array([0.0, 8.0, 0.0, 12.0])
    assert travel.layered_seconds(km, z, [0.0], [6.0]) == pytest.approx(np.hypot(km, z) / 6)
    # Two layers, source at the surface: direct, then the head wave beyond the crossing distance.
    h, v1, v2 = 30.0, 6.0, 8.0
    x = np.array([10.0, 100.0, 150.0, 200.0, 400.0])
    head = x / v2 + 2 * h * np.sqrt(1 / v1**2 - 1 / v2**2)
    cross = 2 * h * np.sqrt((v2 + v1) / (v2 - v1))
    assert travel.layered_seconds(x, np.zeros(5), [0.0, h], [v1, v2]) == pytest.approx(np.where(x < cross, x / v1, head), rel=1e-6)
    # A source below an interface: the direct ray is the quickest path through a point of the interface (Fermat).
    far, deep = 60.0, 45.0
    p = np.linspace(0, far, 200_001)
    fermat = (np.hypot(p, deep - h) / v2 + np.hypot(far - p, h) / v1).min()
    assert travel.layered_seconds(np.array([far]), np.array([deep]), [0.0, h], [v1, v2])[0] == pytest.approx(fermat, rel=1e-7)
    # A slower layer below sends no head wave.
    assert travel.layered_seconds(np.array([300.0]), np.array([0.0]), [0.0, 10.0], [6.0, 5.0])[0] == pytest.approx(50.0)


def test_uneven_table_reports_what_is_outside(spark, tmp_path):
    path = str(tmp_path / "table")
    grid = spark.createDataFrame([(float(x), float(z)) for x in (0, 1, 5, 30, 200) for z in (0, 2, 20)], "distance double, depth double")
    travel.write_table(travel.layered_table(grid, [0.0, 15.0], {"P": [6.0, 8.0], "S": [3.4, 4.5]}), path)
    table = travel.read_table(spark, path)
    nodes = travel.looked_up(grid.withColumn("pha", F.lit("S")), table).collect()
    for r in nodes:
        assert not r.outside and r.seconds == pytest.approx(float(travel.layered_seconds(np.array(r.distance), np.array(r.depth), [0.0, 15.0], [3.4, 4.5])))
    points = [("P", 10.0, 1.0), ("P", 200.1, 1.0), ("P", 3.0, -0.1), ("X", 3.0, 1.0), ("P", None, 1.0), (None, 3.0, 1.0), ("P", 200.0, 20.0)]
    got = travel.looked_up(spark.createDataFrame(points, "pha string, distance double, depth double"), table).collect()
    assert [r.outside for r in got] == [False, True, True, True, True, True, False] and all((r.seconds is None) == r.outside for r in got)
    x, t = table.distances["P"], table.seconds["P"]
    a, b = t[2, 0] * 0.5 + t[2, 1] * 0.5, t[3, 0] * 0.5 + t[3, 1] * 0.5
    assert got[0].seconds == pytest.approx(a + (10 - x[2]) / (x[3] - x[2]) * (b - a))
    with pytest.raises(ValueError, match="whole grid"):
        travel.table_of(travel.layered_table(grid.where("distance + depth < 220"), [0.0], {"P": [6.0]}))
