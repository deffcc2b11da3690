"""Checks of a catalog: every check gives a row, passed or not."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def against_reference(picks: DataFrame, reference: DataFrame, share: float = 0.1) -> DataFrame:
    """Counts by station against reference values within ``share``; stations without one need a pick.
    ``reference``: tid, ref_p, ref_s."""
    counts = picks.groupBy("tid").agg(F.count_if(F.col("pha") == "P").alias("n_p"), F.count_if(F.col("pha") == "S").alias("n_s"))
    near = lambda n, ref: F.when(F.col(ref).isNull(), F.col(n) > 0).otherwise(F.abs(F.col(n) - F.col(ref)) <= F.col(ref) * share)
    return counts.join(reference, "tid", "left").select("tid", "n_p", "n_s", "ref_p", "ref_s", (near("n_p", "ref_p") & near("n_s", "ref_s")).alias("passed"))


def pick_checks(picks: DataFrame) -> DataFrame:
    """Offending rows of each check, in one pass over the picks."""
    tests = {
        "conf_range": ~F.col("conf").between(0, 1) | F.col("conf").isNull(),
        "phase_known": ~F.col("pha").isin("P", "S") | F.col("pha").isNull(),
        "peak_in_window": (F.col("peak") < F.col("start_ts")) | (F.col("peak") > F.col("end_ts")),
        "amp_null": F.col("amp").isNull(),
        "amp_nan": F.isnan("amp"),
        "fields_present": functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("tid", "cha", "pha", "peak", "rid")]),
    }
    sums = picks.agg(*(F.count_if(t).alias(n) for n, t in tests.items()))
    long = sums.unpivot([], list(tests), "check", "offending")
    return long.withColumn("passed", (F.col("offending") == 0) | F.col("check").isin("amp_nan"))


def class_checks(windows: DataFrame, labels: list[str]) -> DataFrame:
    """Windows whose probabilities are outside [0, 1] or missing, by class."""
    sums = windows.agg(*(F.count_if(~F.col(c).between(0, 1) | F.col(c).isNull()).alias(c) for c in labels))
    return sums.unpivot([], labels, "label", "offending")


def coverage_complete(coverage: DataFrame, work: DataFrame) -> DataFrame:
    """Work without a coverage row, and the verdict."""
    have = coverage.select("tid", "yr", "doy").distinct()
    want = work.select("tid", F.year("day").alias("yr"), F.dayofyear("day").alias("doy")).distinct()
    lost = want.join(have.withColumn("_there", F.lit(1)), ["tid", "yr", "doy"], "left")
    return lost.agg(F.count("*").alias("expected"), F.count("_there").alias("present")).withColumn("passed", F.col("present") >= F.col("expected"))


def class_records(classes: DataFrame, fields: tuple[str, ...] = ("eq", "px", "su")) -> DataFrame:
    """Checks of a classifier's records: that there are any, that probabilities are in [0, 1], that no field is missing."""
    outside = functools.reduce(lambda a, b: a | b, [F.coalesce(~F.col(c).between(0, 1), F.lit(False)) for c in fields])
    missing = functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in (*fields, "start_ts")])
    sums = classes.agg((F.count("*") == 0).cast("long").alias("classes_written"), F.count_if(outside).alias("class_probabilities"), F.count_if(missing).alias("class_fields"))
    return sums.unpivot([], ["classes_written", "class_probabilities", "class_fields"], "check", "offending").withColumn("passed", F.col("offending") == 0)


def verify(picks: DataFrame, coverage: DataFrame, work: DataFrame, reference: DataFrame, rid: str | None = None, classes: DataFrame | None = None, request: tuple[Column, Column] | None = None) -> DataFrame:
    """All checks as rows (check, offending, passed), scoped to one run if given. ``classes``: what a classifier has
    written, if it was asked to; ``request``: begin and end (exclusive) of the requested time."""
    scoped = lambda df: df if rid is None else df.where(F.col("rid") == rid)
    own = scoped(picks)
    counts = against_reference(own, reference).agg(F.lit("counts").alias("check"), F.count_if(~F.col("passed")).alias("offending")).withColumn("passed", F.col("offending") == 0)
    cover = coverage_complete(coverage, work).select(F.lit("coverage").alias("check"), (F.col("expected") - F.col("present")).alias("offending"), "passed")
    parts = [pick_checks(own), counts, cover]
    if request is not None:
        out = (F.col("peak") < request[0]) | (F.col("peak") >= request[1])
        parts.append(own.agg(F.lit("peak_in_request").alias("check"), F.count_if(out).alias("offending")).withColumn("passed", F.col("offending") == 0))
    if classes is not None:
        parts.append(class_records(scoped(classes)))
    return functools.reduce(DataFrame.unionByName, parts)
