"""What grows with the tables: rows that joins make, memory, and results on tables with many equal keys."""

import datetime
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pickspark import registry
from pickspark.functions import columns as C
from pickspark.operators import associate, bench, joins, matching, signal
from pickspark.plans import planning
from pickspark.plans.fixtures import Views
from pickspark.sources import writers

SF = "/root/testdata/sf0.001"
T0 = datetime.datetime(2024, 1, 8)


def ran(df):
    """The rows, and the most rows that a step of the executed plan made."""
    rows = df.collect()

    def most(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return most(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return most(p.plan())
        made = p.metrics().get("numOutputRows")
        return max([made.get().value() if made.isDefined() else 0, *(most(p.children().apply(i)) for i in range(p.children().size()))])

    return rows, most(df._jdf.queryExecution().executedPlan())


def hourly(spark, n_traces, n_picks, length=64):
    """Traces of one station by the hour, and picks at whole hours from before their begin to after their end."""
    traces = spark.range(n_traces).select(
        F.lit(1).alias("station_no"), "id", F.element_at(F.array(*map(F.lit, "ZNE")), (F.col("id") % 3 + 1).cast("int")).alias("component"), F.lit(T0).cast("timestamp_ntz").alias("t0"), F.lit(1 / 3600).alias("rate_hz"),
        F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.sin(i * 7.0 + F.col("id"))).alias("samples"),
    )
    picks = spark.range(n_picks).select(F.col("id").alias("pick_id"), F.lit(1).alias("station_no"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 80 - 8).cast("int"))).alias("peak"))
    return traces, picks


def plain_amplitudes(traces, picks, before, after, margin):
    out = {}
    for p in picks:
        at = round((p.peak - T0).total_seconds() / 3600)
        i, j = at - before, at + after + 1
        tops = [(t.component, max(abs(x) for x in t.samples[i:j])) for t in traces if t.station_no == p.station_no and i >= margin and j <= len(t.samples) - margin]
        flat = [x for c, x in tops if c in "NE"]
        out[p.pick_id] = (sum(flat) / len(flat) if flat else math.nan, max((x for _, x in tops), default=math.nan))
    return out


def test_amplitudes_are_measured_once_a_window(spark):
    traces, picks = hourly(spark, 30, 2000)
    picks = picks.unionByName(spark.createDataFrame([(5000, 9, T0), (5001, None, T0), (5002, 1, None)], "pick_id long, station_no int, peak timestamp_ntz"))
    found, most = ran(signal.amplitudes(picks, traces, ["station_no"], 3 * 3600.0, 4 * 3600.0, 3 * 3600.0))
    assert most < 30 * 64 + 2 * 2003
    wanted = plain_amplitudes(traces.collect(), picks.where("peak IS NOT NULL").collect(), 3, 4, 3) | {5002: (math.nan, math.nan)}
    assert len(found) == len(wanted) == 2003
    for row in found:
        assert (row.amp, row.amp_raw) == pytest.approx(wanted[row.pick_id], abs=1e-12, nan_ok=True)


def test_raw_amplitudes_are_measured_once_a_window(spark):
    traces, picks = hourly(spark, 30, 2000)
    found, most = ran(signal.raw_amplitudes(picks, traces, ["station_no"], 3 * 3600.0, 5 * 3600.0, 1e-5))
    assert most < 30 * 64 + 2 * 2000
    flat = traces.withColumn("samples", C.taper(C.detrend(F.col("samples")), F.col("rate_hz"))).collect()
    kept = [t.asDict() | {"samples": signal.filtered(t.samples, t.rate_hz, 1e-5).tolist()} for t in flat]
    wanted = plain_amplitudes([Row(**t) for t in kept], picks.collect(), 3, 5, 1)
    assert len(found) == len(wanted) == 2000
    for row in found:
        assert row.amp_raw_peak == pytest.approx(wanted[row.pick_id][1], abs=1e-9, nan_ok=True)


def test_points_on_an_edge_are_not_inside(spark):
    triangle = [(-124.0, 33.0), (-116.0, 33.0), (-124.0, 41.0)]
    points = {"corner": (33.0, -124.0), "south": (33.0, -120.0), "west": (35.0, -124.0), "slope": (37.0, -120.0), "top": (41.0, -124.0), "in": (33.01, -123.99), "out": (32.99, -120.0), "beyond": (33.0, -115.0), "before": (33.0, -125.0)}
    for closed in (triangle, [*triangle, triangle[0]], triangle[::-1]):
        ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in closed])
        rings = spark.range(1).select(F.lit("triangle").alias("region"), ring.alias("ring"))
        stations = spark.createDataFrame([(k, *v) for k, v in points.items()], "id string, latitude double, longitude double")
        assert [x.id for x in joins.in_regions(stations, rings).collect()] == ["in"]


def test_groups_of_equal_ids_do_not_depend_on_the_order_of_rows(spark):
    rows = [(f"N.S{i // 5:02d}.", f"2024.{1 + i * 7 % 30:03d}") for i in range(400)]
    groups = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda x: hash(x[1]))):
        stations = spark.createDataFrame(order, "id string, start_date string").repartition(7)
        groups.append(sorted(tuple(r) for r in planning.grouped_stations(stations, 13, 60).collect()))
    assert groups[0] == groups[1] == groups[2]
    assert groups[0] == sorted((*x, k // 13) for k, x in enumerate(sorted(rows)))


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    """The events with users from 10,000 on, whose stations have equal ids (ids have four digits)."""
    root = tmp_path_factory.mktemp("tables")
    spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.col("user_id") * 3 + 12340).write.parquet(f"{root}/events.parquet")
    return str(root)


def test_difference_keeps_copies(spark, many_users):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{many_users}/events.parquet/*.parquet'")
    wanted = sorted(con.execute(registry.ORACLES["g02_difference"]).fetchall())
    assert sorted(tuple(x) for x in registry.QUERIES["g02_difference"](spark, many_users).collect()) == wanted
    assert len(set(wanted)) < len(wanted)


def test_days_without_a_component_have_no_amplitudes(spark, tmp_path):
    """The last 56 traces make a day with two components of six stations."""
    for name in ("events", "embeddings"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        (table.where("vec_id < 206") if name == "embeddings" else table).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = registry.QUERIES["j04_picking_job"](spark, str(tmp_path))
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({registry.ORACLES['j04_picking_job']}) x").fetchall()
    assert sorted(tuple(x) for x in found.collect()) == sorted(wanted)


def test_shared_traces_are_measured_once(spark, tmp_path, monkeypatch):
    """Forty stations of each number, some listed twice: traces, scores and amplitudes are those of the numbers, and the
    catalog has the picks of each station."""
    events, sql = spark.read.parquet(f"{SF}/events.parquet"), registry.ORACLES["j04_picking_job"]
    number = F.col("event_id") % 1000 * 2 + 1000
    users = events.withColumn("user_id", F.explode(F.array(number, number * 10)))
    users.write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 206").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for name in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    simulated, dealt = [], []
    monkeypatch.setattr(signal, "simulate", lambda traces, *a, f=signal.simulate: simulated.append(traces.count()) or f(traces, *a))
    monkeypatch.setattr(writers, "write_picks", lambda rows, *a, f=writers.write_picks, **b: dealt.append(rows.rdd.getNumPartitions()) or f(rows, *a, **b))
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    found = registry.QUERIES["j04_picking_job"](spark, str(tmp_path))
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({sql}) x").fetchall()
    rows = sorted(tuple(x) for x in found.collect())
    assert rows == sorted(wanted) and len(rows) > 400
    assert simulated[0] <= 206 and dealt[0] >= -(-sum(x[4] for x in rows) // 1000)


def test_lead_sweep_decides_once_a_window(spark):
    traces, picks = hourly(spark, 30, 2000)
    traces = traces.withColumnRenamed("rate_hz", "rate").withColumn("label", F.col("id") % 4)
    picks = picks.withColumn("pha", F.when(F.col("pick_id") % 3 == 0, "S").otherwise("P"))
    expected = F.element_at(F.array(*map(F.lit, C.CLASS_ORDER)), (F.col("label") + 1).cast("int"))
    predicted = C.argmax_label(C.CLASS_ORDER, [F.array_max(F.slice("window", 5 * i + 1, 5)) for i in range(4)])
    found, most = ran(bench.lead_sweep(picks, traces, ["station_no"], [3 * 3600.0, 9 * 3600.0], 20, predicted, expected))
    assert most < 2 * 2000 + 30 * 64
    wanted, every = {}, traces.collect()
    for p in picks.where("pha = 'P'").collect():
        for t in every:
            for lead in (3, 9):
                i = round((p.peak - T0).total_seconds() / 3600) - lead
                if 0 <= i <= 44:
                    top = [max(t.samples[i + 5 * k : i + 5 * k + 5]) for k in range(4)]
                    n = wanted.setdefault((lead * 3600.0, C.CLASS_ORDER[t.label]), [0, 0])
                    n[0], n[1] = n[0] + 1, n[1] + (top.index(max(top)) == t.label)
    assert {(x.lead, x.expected): [x.n, round(x.n * x.agreement)] for x in found} == wanted


def test_windows_make_only_pairs_that_come_out(spark):
    traces, picks = hourly(spark, 30, 2000)
    traces, picks = traces.withColumnRenamed("rate_hz", "rate"), picks.withColumn("pha", F.when(F.col("pick_id") % 3 == 0, "S").otherwise("P"))
    every, own = traces.collect(), picks.collect()
    at = lambda p: round((p.peak - T0).total_seconds() / 3600)
    found, most = ran(joins.cut_windows(picks, traces, ["station_no"], 3 * 3600.0, 5 * 3600.0, {"first": F.get("samples", F.col("start"))}))
    wanted = sorted((p.pick_id, t.id, at(p) - 3, 8, t.samples[at(p) - 3]) for p in own for t in every if 0 <= at(p) - 3 <= 56)
    assert sorted((x.pick_id, x.id, x.start, x.length, x["first"]) for x in found) == wanted and most == len(wanted)
    found, most = ran(joins.anchored_windows(picks, traces, ["station_no"], 15 * 3600.0, 20))
    wanted = sorted((p.pick_id, t.id, at(p) - 15, t.samples[at(p) - 15 : at(p) + 5]) for p in own for t in every if p.pha == "P" and 0 <= at(p) - 15 <= 44)
    assert sorted((x.pick_id, x.id, x.start, x.window) for x in found) == wanted and most == len(wanted)


def test_nearest_in_space_time_makes_few_pairs(spark):
    """Many origins of a month, some far away from all curated ones, and some with curated ones of one time."""
    place = lambda n: spark.range(n).select("id", (F.col("id") * 7919 % 2592000).alias("s"), (F.col("id") % 97 / 20.0).alias("latitude"), (F.col("id") % 89 / 20.0).alias("longitude"))
    named = lambda df: df.select(F.col("id").alias("origin_id"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s").cast("decimal(18,6)"))).alias("time"), "latitude", "longitude")
    origins = named(place(600).withColumn("latitude", F.when(F.col("id") % 100 == 0, 60.0).when(F.col("id") % 50 == 0, 20.0).otherwise(F.col("latitude"))))
    curated = named(place(5000).withColumns({"s": F.floor(F.col("s") / 60) * 60, "latitude": F.when(F.col("id") == 3, 20.0).otherwise(F.col("latitude"))}))
    found = joins.nearest_in_space_time(origins, curated, 43200.0, 150.0)
    pairs = joins.range_join(origins, curated.select(*(F.col(c).alias(f"c_{c}") for c in curated.columns)), [], "time", "c_time", 43200.0, 43200.0)
    km = C.haversine_km(F.col("latitude"), F.col("longitude"), F.col("c_latitude"), F.col("c_longitude"))
    wanted = pairs.where(km <= 150.0).groupBy("origin_id").agg(F.min(F.struct(F.abs("dt").alias("dt"), "c_origin_id")).alias("x")).select("origin_id", "x.c_origin_id").collect()
    rows, most = ran(found)
    assert sorted((x.origin_id, x.c_origin_id) for x in rows) == sorted(tuple(x) for x in wanted) and len(rows) > 580
    assert most < 5000 + 12 * 200


def test_association_spreads_over_more_tasks(spark):
    rows = spark.range(1000)
    assert associate.dealt(rows, 9, ["id"]).rdd.getNumPartitions() == 9
    assert associate.dealt(rows, 1, ["id"]).rdd.getNumPartitions() <= 4


def test_association_moves_its_rows_once(spark):
    """Blocks are divided and picks chosen where the rows of the coarsest block lie, and candidates hold no picks."""
    v, search = Views(spark, SF), associate.Search((32.0, 42.0, -125.0, -115.0), 1.0, (10.0,), 7200.0, 300.0, n_picks=2, n_p=1, n_s=1, n_both=0)
    picks, stations = (df.localCheckpoint() for df in (v.picks, v.stations))
    found = associate.candidates(associate.votes(picks, stations, search, 3), search)
    assert search.levels == 2 and len(found.collect()) > 0
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(by") == plan.count("Exchange hashpartitioning(") - plan.count("Exchange hashpartitioning(tid") == 1
    assert "stations" not in found.columns


def test_association_moves_a_pick_once_for_all_places(spark, monkeypatch):
    """Every station is listed at thirty places around its own."""
    v, search = Views(spark, SF), associate.Search((32.0, 42.0, -125.0, -115.0), 1.0, (10.0,), 7200.0, 300.0, n_picks=4, n_p=1, n_s=1, n_both=1)
    picks, own = (df.localCheckpoint() for df in (v.picks, v.stations.select("id", "latitude", "longitude")))
    listed = own.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(29)))).withColumn("latitude", F.col("latitude") + F.col("_n") / 100).drop("_n").localCheckpoint()
    assert associate.unplaced(picks, listed, search).count() < 1.5 * associate.coarsest(picks, own, search).count()
    some = []
    for most in (10**6, 0):
        monkeypatch.setattr(associate, "MOST_PLACES", most)
        some.append([sorted(map(tuple, df.collect())) for df in associate.associate(picks, listed, search)])
    assert some[0] == some[1] and len(some[0][0]) > 0


def streamed(t, ref, new, tol):
    """What each reference takes, by one queue a group."""
    out, bounds = [-1] * len(t), [*np.flatnonzero(new).tolist(), len(t)]
    for lo, hi in zip(bounds, bounds[1:]):
        m, got = matching.Matching(float(tol[lo])), []
        for k in range(lo, hi):
            got += m.push(float(t[k]), k, 0 if ref[k] else 1)
        for i, c, _ in got + m.end():
            if i is not None and c is not None:
                out[i] = c
    return out


@pytest.mark.parametrize("alone", [0, 3, 40])
def test_chains_in_step_match_as_streamed(monkeypatch, alone):
    monkeypatch.setattr(matching, "ALONE", alone)
    rng = np.random.default_rng(1)
    for trial in range(120):
        n = int(rng.integers(1, 400))
        group = np.sort(rng.integers(0, int(rng.integers(1, 30)), n))
        t = rng.integers(0, int(rng.choice([5, 50, 500])), n).astype(float) if trial % 2 else rng.uniform(0, 100, n)
        t = (t + 1.7e9 * (trial % 3 == 0))[np.lexsort((t, group))]
        new = np.concatenate([[True], np.diff(group) != 0])
        ref, tol = rng.random(n) < rng.choice([0.2, 0.5, 0.8]), np.array([1.0, 3.0, 10.0])[group % 3]
        assert matching.greedy(t, ref, new, tol).tolist() == streamed(t, ref, new, tol)


def test_levels_of_a_sweep_share_their_rows(spark, monkeypatch):
    rng = random.Random(7)
    time = lambda: T0 + datetime.timedelta(seconds=rng.randrange(0, 900))
    ref = [(f"s{k % 3}" if k % 9 else None, time(), k) for k in range(300)]
    cand = [(f"s{k % 3}" if k % 7 else None, time(), k, rng.choice([0.1, 0.3, 0.6, math.nan, None])) for k in range(400)]
    r = spark.createDataFrame(ref, "tid string, time timestamp_ntz, arrival_id long")
    c = spark.createDataFrame(cand, "tid string, peak timestamp_ntz, pick_id long, conf double")
    seen, islands = [], matching.islands
    monkeypatch.setattr(matching, "islands", lambda rows, *a: seen.append(rows.count()) or islands(rows, *a))
    monkeypatch.setattr(matching, "ROWS", 30, raising=False)  # islands are settled in parts
    monkeypatch.setattr(matching, "LEVELS", 3, raising=False)
    levels = [0.05, 0.2, 0.5]

    def wanted(cand, tol):
        rows = sorted([((x[1] - T0).total_seconds(), x[2], 0, x[0] or "") for x in ref] + [((x[1] - T0).total_seconds(), x[2], 1, x[0] or "") for x in cand], key=lambda x: (x[3], *x[:3]))
        t, side = np.array([x[0] for x in rows]), np.array([x[2] for x in rows])
        took = np.array(streamed(t, side == 0, np.array([i == 0 or rows[i][3] != rows[i - 1][3] for i in range(len(rows))]), np.full(len(rows), tol)))
        off = [abs(t[c] - t[i]) for i, c in enumerate(took) if c >= 0]
        return len(ref), len(off), len(cand) - len(off), sum(off) / len(off)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {x.threshold: (x.analyst, x.matched, x.extra, x.mae) for x in matching.sweep(r, c, levels, ["tid"], 4.0).collect()}
        tols = {x.tol: (x.analyst, x.matched, x.extra, x.mae) for x in matching.tolerance_sweep(r, c, [1.0, 4.0, 9.0], ["tid"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for x in levels:  # NaN is over every threshold, null over none
        assert found[x] == pytest.approx(wanted([y for y in cand if y[3] is not None and not y[3] < x], 4.0))
    for x in (1.0, 4.0, 9.0):
        assert tols[x] == pytest.approx(wanted(cand, x))
    assert len(seen) == 2 and max(seen) <= len(ref) + len(cand)
