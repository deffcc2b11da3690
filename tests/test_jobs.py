import datetime

import pytest
from pyspark.sql import functions as F

from pickspark.sources import jobs, readers

T0 = datetime.datetime(2024, 1, 30)


def picks(spark, job, n, tid="N1.A.", conf=0.5, rid="r1"):
    rows = [(job, tid, "HH", "P", *(T0 + datetime.timedelta(hours=7 * i, seconds=s) for s in (0, 1, 2)), conf, 1.0, 1.0, rid) for i in range(n)]
    return spark.createDataFrame(rows, "job_id string, tid string, cha string, pha string, start_ts timestamp_ntz, peak timestamp_ntz, end_ts timestamp_ntz, conf double, amp double, amp_raw double, rid string")


def content(spark, root):
    return sorted((r.tid, r.peak, round(r.conf, 3)) for r in jobs.picks(spark, root).collect())


def test_killed_writer_leaves_nothing_and_repeats(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "a")
    jobs.write_jobs(picks(spark, "j1", 5), root)
    before = content(spark, root)

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    monkeypatch.setattr(jobs, "publish", killed)
    for _ in range(2):  # files are there, the manifest is not
        with pytest.raises(RuntimeError):
            jobs.write_jobs(picks(spark, "j2", 7, "N2.B."), root)
    monkeypatch.undo()
    assert content(spark, root) == before and len(list((tmp_path / "a" / "data").iterdir())) == 3
    for _ in range(2):
        jobs.write_jobs(picks(spark, "j2", 7, "N2.B."), root)
    after = content(spark, root)
    assert len(after) == 12 and sum(t == "N2.B." for t, _, _ in after) == 7
    assert jobs.coverage(spark, root).where("tid = 'N2.B.'").agg(F.sum("npks")).first()[0] == 7
    # Attempts that nothing names go; what is named stays.
    assert jobs.sweep(spark, root, datetime.datetime.now(datetime.UTC) + datetime.timedelta(minutes=1)) == 3
    assert content(spark, root) == after


def test_manifest_says_what_was_written(spark, tmp_path):
    root = str(tmp_path / "b")
    days = spark.createDataFrame([("j1", "N1.A.", "HH", 2024, d, "r1") for d in (30, 31, 99)], "job_id string, tid string, cha string, yr int, doy int, rid string")
    jobs.write_jobs(picks(spark, "j1", 9), root, handled=days)
    row = jobs.manifests(spark, root).first()
    assert (row.job_id, row.run_id, row.n_picks, row.station_days) == ("j1", "r1", 7, 3)  # two are of February, not handled
    assert sum(f.rows for f in row.files) == 9 and {(f.year, f.month) for f in row.files} == {(2024, 1), (2024, 2)}
    assert {(r.doy, r.npks) for r in row.records} == {(30, 4), (31, 3), (99, 0)}


def test_replacing_is_one_step(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    jobs.write_jobs(picks(spark, "j1", 5).union(picks(spark, "j1", 4, "N1.B.")), root)
    jobs.write_jobs(picks(spark, "j2", 3, "N2.C."), root)
    before, ids = content(spark, root), spark.createDataFrame([("N1.A.",)], "id string")
    published = jobs.publish
    monkeypatch.setattr(jobs, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        jobs.replace_stations(spark, root, ids, "redo")
    assert content(spark, root) == before
    monkeypatch.setattr(jobs, "publish", published)
    jobs.replace_stations(spark, root, ids, "redo")
    assert content(spark, root) == [x for x in before if x[0] != "N1.A."]
    assert {r.tid for r in jobs.coverage(spark, root).collect()} == {"N1.B.", "N2.C."}
    again = picks(spark, "x", 2, conf=0.9).drop("job_id")
    jobs.replace_stations(spark, root, ids, "redo-2", again)
    assert [x for x in content(spark, root) if x[0] == "N1.A."] == [("N1.A.", T0 + datetime.timedelta(hours=7 * i, seconds=1), 0.9) for i in range(2)]
    assert jobs.coverage(spark, root).where("tid = 'N1.A.'").agg(F.sum("npks")).first()[0] == 2
    # A partition that is left without picks.
    jobs.replace_stations(spark, root, spark.createDataFrame([("N2.C.",)], "id string"), "redo-3")
    assert {x[0] for x in content(spark, root)} == {"N1.A.", "N1.B."}


def test_run_documents(spark, tmp_path):
    path = str(tmp_path / "runs")
    run = lambda rid, w: spark.createDataFrame([(rid, "m", w, 0.2, 0.1, "ZNE")], "rid string, model string, weight string, p_threshold double, s_threshold double, components_loaded string")
    jobs.write_runs(run("r1", "a").union(run("r2", "b")), path, datetime.datetime(2024, 5, 6))
    jobs.write_runs(run("r2", "c"), path)
    got = {r.rid: r for r in readers.runs(spark, path).select("rid", "weight", "timestamp").collect()}
    assert {k: r.weight for k, r in got.items()} == {"r1": "a", "r2": "c"} and got["r1"].timestamp == "2024-05-06T00:00:00Z"


def test_empty_catalog(spark, tmp_path):
    root = str(tmp_path / "d")
    jobs.write_jobs(picks(spark, "j1", 0), root, handled=spark.createDataFrame([("j1", "N1.A.", "HH", 2024, 30, "r1")], "job_id string, tid string, cha string, yr int, doy int, rid string"))
    assert content(spark, root) == [] and jobs.coverage(spark, root).first().npks == 0
