import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickspark.operators import associate
from pickspark.operators.associate import Search
from pickspark.plans.fixtures import Views

T0 = datetime.datetime(2024, 1, 1)
PLACES = {f"A.S{i:02d}.": (34.0 + 0.27 * (i % 5), -118.0 + 0.31 * (i // 5)) for i in range(20)}
SMALL = Search((34.0, 35.1, -118.0, -117.1), 0.1, (0.0, 10.0), 1.5, 90.0, n_picks=8, n_p=3, n_s=3, n_both=3)


def km(a, b):
    h = np.radians([(a[0] - b[0]) / 2, (a[1] - b[1]) / 2])
    return 2 * 6371 * np.arcsin(np.sqrt(np.sin(h[0]) ** 2 + np.cos(np.radians(a[0])) * np.cos(np.radians(b[0])) * np.sin(h[1]) ** 2))


def planted(events, noise, rng, jitter=0.1):
    """Rows of picks: of each event at the stations within 90 km, and noise."""
    rows = []
    for lat, lon, depth, t in events:
        for sid, place in PLACES.items():
            if (d := km((lat, lon), place)) <= 90:
                for pha, slow in (("P", 1 / 6), ("S", 1.75 / 6)):
                    rows.append((sid, pha, t + np.hypot(d, depth) * slow + rng.uniform(-jitter, jitter)))
    rows += [(rng.choice(list(PLACES)), rng.choice(["P", "S"]), rng.uniform(0, 4000)) for _ in range(noise)]
    return [(i, str(s), str(p), T0 + datetime.timedelta(seconds=float(t))) for i, (s, p, t) in enumerate(rows)]


def frames(spark, rows):
    stations = spark.createDataFrame([(k, *v) for k, v in PLACES.items()], "id string, latitude double, longitude double")
    return spark.createDataFrame(rows, "pick_id long, tid string, pha string, peak timestamp_ntz"), stations


def found(spark, rows, search):
    events, own = associate.associate(*frames(spark, rows), search)
    return sorted(map(tuple, events.drop("event_id").collect())), own


def test_search_equals_the_full_grid(spark, monkeypatch):
    rng = np.random.default_rng(4)
    events = [(34.4, -117.6, 5.0, 500.0), (34.8, -117.3, 8.0, 505.0), (34.2, -117.9, 2.0, 2000.0), (35.0, -117.2, 9.0, 3000.0)]
    rows = planted(events, 150, rng)
    some, own = found(spark, rows, SMALL)
    assert SMALL.levels >= 3 and len(some) >= 3
    monkeypatch.setattr(Search, "levels", property(lambda self: 0))
    assert some == found(spark, rows, SMALL)[0]


def test_planted_events_and_their_picks(spark):
    rng = np.random.default_rng(5)
    events = [(34.4, -117.6, 5.0, 500.0), (34.7, -117.4, 8.0, 1500.0), (34.3, -117.8, 2.0, 2500.0)]
    rows = planted(events, 60, rng)
    # A second P at a station of the first event, next to its own.
    extra = next(r for r in rows if r[2] == "P")
    rows.append((len(rows), extra[1], "P", extra[3] + datetime.timedelta(seconds=0.3)))
    picks, stations = frames(spark, rows)
    got, own = associate.associate(picks, stations, SMALL)
    got, own = got.collect(), own.collect()
    assert len(got) == 3
    for lat, lon, depth, t in events:
        best = min(got, key=lambda r: abs((r.time - T0).total_seconds() - t))
        assert abs((best.time - T0).total_seconds() - t) < 1.5 and km((best.lat, best.lon), (lat, lon)) < 12
        mine = [r for r in own if r.event_id == best.event_id]
        assert len(mine) == best.n_picks == best.n_p + best.n_s and best.n_picks >= 16
        assert len({(r.tid, r.pha) for r in mine}) == len(mine)
        assert all(abs(r.residual) <= SMALL.tolerance for r in mine)
        assert best.n_both == len({r.tid for r in mine if r.pha == "P"} & {r.tid for r in mine if r.pha == "S"})
    assert len({r.pick_id for r in own}) == len(own)


def test_few_votes_a_pick(spark):
    """Each pick meets few blocks and bins, where the full grid has thousands."""
    v = Views(spark, "/root/testdata/sf0.01")
    search = Search((32.0, 42.0, -125.0, -115.0))
    first = associate.coarsest(v.picks, v.stations, search)
    assert first.count() < 100 * v.picks.count()
    assert associate.votes(v.picks, v.stations, search).count() == 0


def test_no_picks_and_other_phases(spark):
    assert found(spark, [], SMALL)[0] == []
    assert found(spark, [(1, "A.S00.", "X", T0), (2, "A.S00.", "P", T0), (3, "nowhere", "P", T0)], SMALL)[0] == []


def test_spread_is_exact_for_epoch_seconds(spark):
    rows = [(k, f"s{k}", "P", 1_700_000_000.0 + t, 0.0, 0.0, 0, 0) for k, t in enumerate((0.1, 0.2, 0.9))]
    cast = spark.createDataFrame(rows, "pick_id int, tid string, pha string, t double, latitude double, longitude double, by int, bx int")
    search = Search((0.0, 1.0, 0.0, 1.0), depths=(0.0,), tolerance=3.0, n_picks=1, n_p=1, n_s=0, n_both=0)
    row = associate.candidates(cast.withColumn("bin", F.floor(F.col("t") / 6)), search).where("shift = 0").first()
    assert row.spread == pytest.approx(np.std([0.1, 0.2, 0.9]), abs=1e-6) and row.origin == pytest.approx(1_700_000_000.4)
