"""A catalog written by jobs, each of which becomes visible by one document: its manifest.

A job's files go to a folder of the attempt that writes them. Its manifest, written last, names them with their row
counts, and the station-days it has covered; readers see the files that manifests name and no others. So an attempt
that dies leaves nothing that is read, one that is repeated counts once, and a job written again takes the place of what
it wrote before, at once. A job may also name files of others that it replaces.

A job is a unit of the plan (some thousand station-days): its document is one row. Many jobs are written together, each
with a document of its own.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as C
from . import readers, writers

DATA, MANIFESTS = "data", "manifests"


def documents(rows: DataFrame, name: Column, path: str) -> None:
    """One JSON document for each row, in a folder of its name."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), name.alias("of")).repartition("of").write.mode("append").partitionBy("of").text(path)


def write_runs(runs: DataFrame, path: str, created: datetime.datetime | None = None) -> None:
    """One provenance document for each run (``rid`` and what was run). A run that is written again replaces its
    document; the others stay."""
    stamp = (created or datetime.datetime.now(datetime.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = runs if "timestamp" in runs.columns else runs.withColumn("timestamp", F.lit(stamp))
    own = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), F.col("rid").alias("of")).repartition("of")
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("of").text(path)


def write_files(picks: DataFrame, root: str, attempt: str, most_rows: int = 4_000_000) -> DataFrame:
    """Write placed picks with their ``job_id`` to the attempt's folder; returns job_id, path below ``root``,
    network, year, month and rows of each file."""
    spark, path = picks.sparkSession, f"{root.rstrip('/')}/{DATA}/attempt={attempt}"
    by = ["job_id", *schemas.PARTITIONS]
    typed = picks.selectExpr("job_id", *(f"cast({n} as {t}) as {n}" for n, t in (f.split(" ") for f in schemas.PICK.split(", "))))
    dealt = typed.hint("rebalance", *map(F.col, by)).sortWithinPartitions(*by, "tid", "peak")
    dealt.write.option("compression", "zstd").option("maxRecordsPerFile", most_rows).partitionBy(*by).parquet(path)
    there = spark.read.schema(typed.schema).option("basePath", path).parquet(path)
    below = F.regexp_extract("_metadata.file_path", f"({DATA}/attempt={attempt}/.*)$", 1)
    return there.groupBy(*by, below.alias("path")).agg(F.count("*").alias("rows"))


def write_jobs(picks: DataFrame, root: str, handled: DataFrame | None = None, day: str = "peak", classes: DataFrame | None = None, removes: list[str] | None = None, forgets: list[str] | None = None) -> str:
    """Write picks (with ``job_id`` and ``rid``) and then the manifests of their jobs. ``handled``: job_id, tid, cha,
    yr, doy, rid of the station-days that were worked on, with picks or not (default: those with picks). ``classes``:
    the same columns and nclfs. ``removes``: files that the (single) job replaces; ``forgets``: stations whose older
    coverage it makes void. Returns the attempt."""
    attempt = uuid.uuid4().hex
    files = write_files(writers.placed(picks, day), root, attempt)
    own = [*schemas.COVERAGE_KEY, "rid"]
    counted = picks.groupBy("job_id", "tid", "cha", F.year(day).alias("yr"), F.dayofyear(day).alias("doy"), "rid").agg(F.count("*").alias("npks"))
    if handled is not None:
        counted = handled.select("job_id", *own).distinct().join(counted, ["job_id", *own], "left")
    scored = classes.groupBy("job_id", *own).agg(F.sum("nclfs").alias("nclfs")) if classes is not None else counted.limit(0).select("job_id", *own, F.lit(0).cast("long").alias("nclfs"))
    counted = counted.join(scored, ["job_id", *own], "full").fillna(0, ["npks", "nclfs"])
    records = counted.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct(*own, "npks", "nclfs"))).alias("records"), F.sum("npks").alias("n_picks"), F.sum("nclfs").alias("n_classifies"), F.count("*").alias("station_days"))
    named = files.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct(F.lit("picks").alias("kind"), "path", "rows", *schemas.PARTITIONS))).alias("files"))
    runs = picks.groupBy("job_id").agg(F.max("rid").alias("run_id"))
    each = records.join(named, "job_id", "left").join(runs, "job_id", "left")
    publish(each, root, attempt, removes, forgets)
    return attempt


def publish(jobs: DataFrame, root: str, attempt: str, removes: list[str] | None = None, forgets: list[str] | None = None) -> None:
    """Make jobs visible. Each document appears whole or not at all."""
    stamp = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    lists = {n: F.array(*map(F.lit, x or [])).cast("array<string>") for n, x in (("removes", removes), ("forgets", forgets))}
    out = jobs.withColumns({"written_at": F.lit(stamp), "attempt": F.lit(attempt), **lists})
    documents(out, F.concat_ws("-", F.sha2("job_id", 256), F.lit(attempt)), f"{root.rstrip('/')}/{MANIFESTS}")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """The latest manifest of each job."""
    path = f"{root.rstrip('/')}/{MANIFESTS}"
    whole = spark.read.schema(schemas.MANIFEST).option("recursiveFileLookup", "true").json(path, multiLine=True)
    newest = whole.groupBy("job_id").agg(F.max(F.struct("written_at", "attempt")).alias("_newest"))
    return whole.join(newest, "job_id").where((F.col("written_at") == F.col("_newest.written_at")) & (F.col("attempt") == F.col("_newest.attempt"))).drop("_newest")


def live_files(table: DataFrame) -> DataFrame:
    """Files that manifests name, without those that others replace."""
    gone = table.select(F.explode("removes").alias("path")).distinct()
    return readers.manifest_files(table).join(gone, "path", "left_anti")


def picks(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """The catalog that manifests name, by exact paths; ``files``: some of ``live_files`` (by default all). A
    scan lists no folders; its driver holds the paths, as it does for any table."""
    found = live_files(manifests(spark, root)) if files is None else files
    paths = [r.path for r in found.where("kind = 'picks'").select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schemas.PICK)
    base = f"{root.rstrip('/')}/{DATA}"
    columns = [f.split(" ")[0] for f in schemas.PICK.split(", ")]
    return spark.read.schema(schemas.PICK).option("basePath", base).parquet(*[f"{root.rstrip('/')}/{p}" for p in paths]).select(columns)


def coverage(spark: SparkSession, root: str) -> DataFrame:
    """Station-days that jobs have covered, of each the latest record: what a job claims is in files that its
    manifest names. Records of stations whose picks a later job has deleted are void."""
    table = manifests(spark, root)
    records = readers.manifest_coverage(table).join(table.select("job_id", "written_at"), "job_id")
    gone = table.select(F.explode("forgets").alias("tid"), "written_at").groupBy("tid").agg(F.max("written_at").alias("gone_at"))
    valid = records.join(gone, "tid", "left").where(F.col("gone_at").isNull() | (F.col("written_at") >= F.col("gone_at")))
    newest = F.max_by(F.struct("npks", "nclfs"), F.struct("written_at", "job_id")).alias("x")
    return valid.groupBy(*schemas.COVERAGE_KEY, "rid").agg(newest).select(*schemas.COVERAGE_KEY, "x.npks", "x.nclfs", "rid")


def replace_stations(spark: SparkSession, root: str, ids: DataFrame, job_id: str, again: DataFrame | None = None) -> None:
    """Delete the picks of some stations, and put ``again`` (picks) in their place, at once: the files that hold them
    are written anew without them, balanced and sorted like any, by a job that names the old ones as replaced. A job
    that died before its manifest has changed nothing."""
    gone = ids.select(F.col("id").alias("tid")).distinct()
    names = [r.tid for r in gone.collect()]  # a request's stations, which its document lists
    files = live_files(manifests(spark, root))
    networks = ids.select(C.network_of(F.col("id")).alias("network")).distinct()
    files = files.join(networks, "network", "left_semi")
    old = [r.path for r in files.where("kind = 'picks'").select("path").distinct().collect()]
    if not old and again is None:
        return
    there = picks(spark, root, files)
    kept = there.join(gone, "tid", "left_anti")
    rows = kept if again is None else kept.unionByName(writers.placed(again, "peak").select(kept.columns))
    work = rows.withColumn("job_id", F.lit(job_id))
    if rows.limit(1).count():
        write_jobs(work, root, removes=old, forgets=names)
    else:
        publish(spark.createDataFrame([(job_id,)], "job_id string"), root, uuid.uuid4().hex, old, names)


def sweep(spark: SparkSession, root: str, older_than: datetime.datetime) -> int:
    """Delete folders of attempts that no manifest names and that were last written before a time; returns how many."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{DATA}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    named = {r.attempt for r in live_files(manifests(spark, root)).select(F.regexp_extract("path", "attempt=([^/]*)", 1).alias("attempt")).distinct().collect()}
    most, swept = older_than.timestamp() * 1000, 0
    for folder in files.listStatus(path):
        name = folder.getPath().getName()
        if name.removeprefix("attempt=") not in named and folder.getModificationTime() < most:
            files.delete(folder.getPath(), True)
            swept += 1
    return swept
