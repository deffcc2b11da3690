"""Writers of the catalog and its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as C


def placed(rows: DataFrame, day: str) -> DataFrame:
    """Add the partition columns; year and month are those of the processing day, not of the pick."""
    return rows.withColumns({"network": C.network_of(F.col("tid")), "year": F.year(day), "month": F.month(day)})


def write_catalog(rows: DataFrame, root: str, order: tuple[str, ...] = ("tid", "peak"), mode: str = "append", most_rows: int = 4_000_000, dealt: bool = False) -> None:
    """Hive partitions network, year, month; zstd. Rows are balanced over tasks by partition and split where
    one is large (unless they are ``dealt`` that way already), and sorted by station in each file so that row groups
    can be skipped."""
    balanced = rows if dealt else rows.hint("rebalance", *map(F.col, schemas.PARTITIONS))
    balanced.sortWithinPartitions(*schemas.PARTITIONS, *order).write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", most_rows).partitionBy(*schemas.PARTITIONS).parquet(root)


def write_picks(picks: DataFrame, root: str, day: str = "peak", mode: str = "append", dealt: bool = False) -> None:
    typed = placed(picks, day).selectExpr(*(f"cast({n} as {t}) as {n}" for n, t in (f.split(" ") for f in schemas.PICK.split(", "))))
    write_catalog(typed, root, mode=mode, dealt=dealt)


def write_classifications(rows: DataFrame, root: str, day: str = "start_ts", mode: str = "append") -> None:
    typed = placed(rows, day).selectExpr(*(f"cast({n} as {t}) as {n}" for n, t in (f.split(" ") for f in schemas.CLASSIFY.split(", "))))
    write_catalog(typed, root, ("tid", "start_ts"), mode)


def write_stations(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_units(units: DataFrame, path: str) -> None:
    """JSON lines; refuses to overwrite a plan."""
    units.write.mode("errorifexists").json(path)


def write_events(events: DataFrame, assignments: DataFrame, picks: DataFrame, root: str) -> None:
    """Events, and assignments by the picks' own keys."""
    events.write.mode("append").parquet(f"{root}/events")
    keyed = assignments.join(picks.select("pick_id", *schemas.PICK_KEY), "pick_id").select("event_id", *schemas.PICK_KEY)
    keyed.write.mode("append").parquet(f"{root}/assignments")


def write_coverage(rows: DataFrame, path: str, batch: int | None = None) -> None:
    """Append, or put the rows of one batch in place of those it wrote before."""
    if batch is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def write_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").csv(path, header=True)


def touched(rows: DataFrame) -> list[dict]:
    """Partitions of (placed) rows: as many as one batch touches folders."""
    return [r.asDict() for r in rows.select(*schemas.PARTITIONS).distinct().collect()]


def in_partitions(table: DataFrame, folders: list[dict]) -> DataFrame:
    """The rows of some partitions; others are not read."""
    return table.where(F.struct(*schemas.PARTITIONS).isin([F.struct(*(F.lit(t[c]).alias(c) for c in schemas.PARTITIONS)) for t in folders]))


def catalog_of(spark: SparkSession, root: str) -> DataFrame | None:
    """The catalog's picks, None if nothing is there yet."""
    try:
        return spark.read.schema(schemas.PICK).option("basePath", root).parquet(root)
    except Exception as e:  # the first batch finds no catalog
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def insert_ignoring_duplicates(rows: DataFrame, root: str, day: str = "peak") -> None:
    """Append picks whose key is not there yet; only the partitions that the new rows touch are read."""
    new = placed(rows, day).dropDuplicates(schemas.PICK_KEY)
    folders, there = touched(new), catalog_of(rows.sparkSession, root)
    if there is not None and folders:
        new = new.join(in_partitions(there, folders).select(*schemas.PICK_KEY), schemas.PICK_KEY, "left_anti")
    write_picks(new, root, day)
