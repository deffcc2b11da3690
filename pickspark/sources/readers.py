"""Readers of catalogs, stations, lists, work units and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as C

#: Forms of times in curated event lists.
TIME_FORMS = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss"]


def with_bands(stations: DataFrame) -> DataFrame:
    """Channels as sorted distinct bands, and the location code of the id."""
    return stations.withColumns({"channels": C.band_codes(F.col("channels")), "location_code": F.element_at(F.split("id", r"\."), -1)})


def stations_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Station files with a header, columns in any order."""
    names = [f.split(" ")[0] for f in schemas.STATION.split(", ")]
    frames = []
    for path in paths:
        text = spark.read.csv(path, header=True)
        cols = [F.col(n).cast(t) if n in text.columns else F.lit(None).cast(t) for n, t in (f.split(" ") for f in schemas.STATION.split(", "))]
        frames.append(text.select(*(c.alias(n) for c, n in zip(cols, names))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return with_bands(out)


def stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Sorted distinct ids: of a CSV with a column ``id``, or the first comma token of lines; # begins a comment."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' AND NOT startswith(v, '#')")
    first = F.trim(F.get(F.split("v", ","), F.lit(0)))
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, comment="#").select(F.trim("id").alias("id")).where("id <> ''").distinct().orderBy("id")
    return lines.select(first.alias("id")).where("id <> ''").distinct().orderBy("id")


def network_list(spark: SparkSession, path: str) -> DataFrame:
    """Network codes of a text list, or of a JSON file of name to array of codes (name, network)."""
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("name", "codes")).select("name", F.explode("codes").alias("network"))
    return id_list(spark, path).withColumnRenamed("id", "network")


def units(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.UNIT).json(path)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Many small JSON documents, one a file."""
    return spark.read.schema(schemas.MANIFEST).json(path, multiLine=True)


def manifest_files(table: DataFrame) -> DataFrame:
    return table.select("job_id", "run_id", F.inline("files"))


def manifest_coverage(table: DataFrame) -> DataFrame:
    """Coverage records; their run is the job's where they do not say."""
    rows = table.select("job_id", "run_id", F.inline("records"))
    return rows.withColumn("rid", F.coalesce("rid", "run_id")).drop("run_id")


def runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN).json(path, multiLine=True)


def picks(spark: SparkSession, root: str) -> DataFrame:
    """The partitioned catalog; predicates on network, year and month prune folders."""
    return spark.read.schema(schemas.PICK).option("basePath", root).parquet(root)


def classifications(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.CLASSIFY).option("basePath", root).parquet(root)


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """Coverage as batches have written it: of each key the row of the latest batch that has it."""
    rows = spark.read.schema(f"{schemas.COVERAGE}, batch long").option("basePath", path).parquet(path)
    return rows.groupBy(*schemas.COVERAGE_KEY).agg(F.max_by("npks", "batch").alias("npks"))


def picks_of_unit(spark: SparkSession, root: str, table: DataFrame, job_ids: list[str]) -> DataFrame:
    """Picks by the exact files that the manifests of some jobs name, without listing folders."""
    paths = [r.path for r in manifest_files(table.where(F.col("job_id").isin(job_ids))).where("kind = 'picks'").select("path").distinct().collect()]
    return spark.read.schema(schemas.PICK).option("basePath", root).parquet(*[f"{root.rstrip('/')}/{p}" for p in paths]) if paths else spark.createDataFrame([], schemas.PICK)


def inventory(spark: SparkSession, root: str, most_bytes: int = 200_000_000) -> DataFrame:
    """Objects of an archive with what their padded names say; contents are not read, objects over the size
    limit are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length").where(F.col("length") <= most_bytes)
    return parsed_inventory(files)


def parsed_inventory(files: DataFrame) -> DataFrame:
    parts = C.parse_padded_key(F.col("path"))
    return files.withColumns(parts).withColumns({"cha": C.band_of(F.col("channel")), "component": F.right("channel", F.lit(1))})


def objects(files: DataFrame) -> DataFrame:
    """``files`` (path and more) with what their names say, in any layout; others are left out."""
    return files.withColumn("_key", C.parse_key(F.col("path"))).where("_key IS NOT NULL").select(*files.columns, "_key.*")


def newest_versions(found: DataFrame) -> DataFrame:
    """Of each station-day the object of the highest version (of equal ones the last in order of paths), and how many
    there are. Versions are numbers: 10 is newer than 9."""
    latest = F.max_by("path", F.struct("version", "path"))
    return found.where("layout = 'versioned'").groupBy("net", "sta", "yr", "doy").agg(latest.alias("path"), F.max("version").alias("version"), F.count("*").alias("versions"))


def objects_for(work: DataFrame, found: DataFrame) -> DataFrame:
    """The objects that hold the station-days of ``work`` (net, sta, yr, doy), by key: all channels of the layouts that
    have an object for each, else the newest version. One join, whatever the number of names listed."""
    day = ["net", "sta", "yr", "doy"]
    each = found.where("layout <> 'versioned'").select(*day, "path", "channel", "loc")
    whole = newest_versions(found).select(*day, "path", F.lit(None).cast("string").alias("channel"), F.lit(None).cast("string").alias("loc"))
    return work.select(*day).distinct().join(each.unionByName(whole), day)


def location_codes(objects: DataFrame) -> DataFrame:
    """The first location code, in order of paths, of each station, channel and day."""
    return objects.groupBy("net", "sta", "channel", "yr", "doy").agg(F.min_by("loc", "path").alias("loc"), F.min("path").alias("path"))


def curated_events(rows: DataFrame, t0, t1, lead: float = 180.0) -> DataFrame:
    """Reviewed events of [t0 - lead seconds, t1], times in any known form. Rows whose time does not parse go."""
    text = F.regexp_replace(F.col("time").cast("string"), r"\+00:00$", "Z")
    time = F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMS)).cast("timestamp_ntz")
    return rows.where("status = 'reviewed'").withColumn("time", time).where((F.col("time") >= t0 - F.make_dt_interval(secs=F.lit(lead))) & (F.col("time") <= t1))


def catalog_arrivals(events: DataFrame) -> DataFrame:
    """Arrivals of each event's preferred origin (else the first), joined to their picks by id. ``events``:
    event_id, preferred, origins (id, arrivals of pick_id and phase), picks (pick_id, tid, time, mode)."""
    own = F.coalesce(F.get(F.filter("origins", lambda o: o["id"] == F.col("preferred")), F.lit(0)), F.get("origins", F.lit(0)))
    arrivals = events.select("event_id", F.explode(own["arrivals"]).alias("a")).select("event_id", "a.pick_id", C.phase_of(F.col("a.phase")).alias("pha"))
    found = events.select("event_id", F.explode("picks").alias("p")).select("event_id", "p.*")
    return arrivals.join(found, ["event_id", "pick_id"])
