"""Exact quantiles of many groups at once, without a group that holds its values.

A mergeable sketch brackets each quantile of each group, the values below a bracket are counted, and only what lies
inside is put in order: half a hundredth of a large group's rows, or all of a group of ``SMALL`` rows at most.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

#: Groups up to this size are put in order whole.
SMALL = 1000


def with_keys(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, of which a null equals a null."""
    other = b.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return a.join(other, on, how).drop(*(f"_of_{k}" for k in keys))


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """``keys`` and a column for each wanted quantile (name: share), interpolated between neighbours. Nulls and NaN are
    skipped; groups without other values have no row. ``rows`` is read twice: pass a table."""
    base = rows.select(*keys, C.nan_to_null(F.col(value).cast("double")).alias("_v")).where("_v IS NOT NULL")
    slack, shares = 4.0 / accuracy + 2.0 / SMALL, list(wanted.values())
    at = F.array(*[F.lit(min(max(p + d, 0.0), 1.0)) for p in shares for d in (-slack, slack)])
    around = base.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", at, accuracy).alias("_around"))
    large = F.col("_n") > SMALL
    lo = [F.when(large, F.col("_around")[2 * i]).otherwise(F.lit(float("-inf"))) for i in range(len(shares))]
    hi = [F.when(large, F.col("_around")[2 * i + 1]).otherwise(F.lit(float("inf"))) for i in range(len(shares))]
    # Each value counts below a bracket or inside; values above count for nothing.
    marks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), (F.col("_v") >= lo[i]).alias("inside"), (F.col("_v") <= hi[i]).alias("counts")) for i, p in enumerate(shares)])
    met = with_keys(base, around, keys).select(*keys, "_n", "_v", F.explode(F.filter(marks, lambda m: m["counts"])).alias("_m"))
    of = [*keys, "_n", "_i", "_p"]
    held = met.select(*keys, "_n", F.col("_m.i").alias("_i"), F.col("_m.p").alias("_p"), F.when(F.col("_m.inside"), F.col("_v")).alias("_x")).groupBy(*of, "_x").agg(F.count("*").alias("_c"))
    # A null (what lies below) comes first.
    upto = held.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*of).orderBy(F.asc_nulls_first("_x"))))
    rank = F.col("_p") * (F.col("_n") - 1)
    first = F.min(F.when(F.col("_upto") >= F.floor(rank) + 1, F.col("_x")))
    second = F.min(F.when(F.col("_upto") >= F.least(F.floor(rank) + 2, F.col("_n")), F.col("_x")))
    found = upto.groupBy(*of).agg(first.alias("_a"), second.alias("_b")).withColumn("_q", F.col("_a") + (rank - F.floor(rank)) * (F.col("_b") - F.col("_a")))
    return found.groupBy(*keys).agg(*(F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(name) for i, name in enumerate(wanted)))
