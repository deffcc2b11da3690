"""Benchmark tables: budgets, saturation, confusion, detection, ablation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.shared import cut
from .quantiles import quantiles, with_keys


def pivot_recall(scores: DataFrame, row: str, weights: list[str]) -> DataFrame:
    return scores.groupBy(row).pivot("weight", weights).agg(F.first("recall"))


def matched_budget(curve: DataFrame, targets: int = 5) -> DataFrame:
    """Recall of each model at common numbers of emitted picks, by linear interpolation of its own sweep.
    ``curve``: weight, emitted, recall. No row comes out if the models share no range. The curve is a few
    rows for each model."""
    bounds = curve.groupBy("weight").agg(F.min("emitted").alias("lo"), F.max("emitted").alias("hi")).agg(F.max("lo").alias("lo"), F.min("hi").alias("hi")).where("hi >= lo")
    at = bounds.select(F.explode(F.sequence(F.lit(0), F.lit(targets - 1))).alias("i"), "lo", "hi").select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / F.lit(targets - 1)).alias("budget"))
    by = Window.partitionBy("weight").orderBy("emitted", "recall")
    steps = curve.select("weight", "emitted", "recall", F.lead("emitted").over(by).alias("e1"), F.lead("recall").over(by).alias("r1"))
    inside = (F.col("budget") >= F.col("emitted")) & ((F.col("budget") < F.col("e1")) | F.col("e1").isNull() & (F.col("budget") == F.col("emitted")))
    share = C.ratio(F.col("budget") - F.col("emitted"), F.col("e1") - F.col("emitted"))
    found = steps.join(F.broadcast(at), inside)  # ``targets`` rows
    return found.groupBy("budget", "weight").agg(F.max(F.col("recall") + F.coalesce(share * (F.col("r1") - F.col("recall")), F.lit(0.0))).alias("recall"))


def saturation(picks: DataFrame, levels: list[float], phase: str = "S") -> DataFrame:
    """Picks of a phase at each threshold, by model."""
    return picks.where(F.col("pha") == phase).groupBy("weight").agg(*(F.count_if(F.col("conf") >= x).alias(f"at_{str(x).replace('.', '_')}") for x in levels))


def confusion(decisions: DataFrame, labels: list[str]) -> DataFrame:
    """Expected by predicted, all labels in order, zero-filled."""
    spark = decisions.sparkSession
    every = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, expected string")
    counts = decisions.groupBy("expected").pivot("predicted", labels).count()
    return every.join(counts, "expected", "left").fillna(0, labels).orderBy("i").drop("i")


def class_agreement(decisions: DataFrame) -> DataFrame:
    """Share of right decisions by class, and overall (expected = 'all')."""
    right = F.avg((F.col("expected") == F.col("predicted")).cast("double")).alias("agreement")
    return decisions.rollup("expected").agg(F.count("*").alias("n"), right).withColumn("expected", F.coalesce("expected", F.lit("all")))


def mean_and_max(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("max", F.max))])


def lead_sweep(picks: DataFrame, traces: DataFrame, keys: list[str], leads: list[float], samples: int, predicted: Column, expected: Column) -> DataFrame:
    """Share of right decisions by lead and expected class. Windows of ``samples`` samples that begin each of ``leads``
    seconds before a P are cut; ``predicted`` is evaluated on ``window``, both it and ``expected`` on columns of the traces.

    A window is decided once for each trace, and counts for every pick and lead that has it. So the work grows with the
    picks and with the samples (a trace has no more windows than samples), not with pairs of picks and traces."""
    grid = [*keys, "t0", "rate"]
    lengths = traces.groupBy(*grid).agg(F.max(F.size("samples")).alias("_most"))
    each = picks.where("pha = 'P'").select(*keys, "peak").join(lengths, keys).withColumn("lead", F.explode(F.array(*map(F.lit, leads))))
    start = F.round((C.epoch_seconds(F.col("peak")) - C.epoch_seconds(F.col("t0")) - F.col("lead")) * F.col("rate")).cast("int")
    asked = each.withColumn("start", start).where((F.col("start") >= 0) & (F.col("start") + samples <= F.col("_most"))).groupBy(*grid, "start", "lead").agg(F.count("*").alias("_picks"))
    cut_ = traces.join(asked.select(*grid, "start").distinct(), grid).where(F.col("start") + samples <= F.size("samples"))
    decided = cut_.withColumn("window", F.slice("samples", F.col("start") + 1, samples)).select(*grid, "start", expected.alias("expected"), predicted.alias("predicted"))
    counts = decided.groupBy(*grid, "start", "expected").agg(F.count("*").alias("_n"), F.count(F.col("expected") == F.col("predicted")).alias("_known"), F.count_if(F.col("expected") == F.col("predicted")).alias("_right"))
    total = lambda c: F.sum(F.col("_picks") * F.col(c))
    return asked.join(counts, [*grid, "start"]).groupBy("lead", "expected").agg(total("_n").alias("n"), C.ratio(total("_right"), total("_known")).alias("agreement"))


def detection(rows: DataFrame, by: list[str]) -> DataFrame:
    """Windows, detections, rate and median offset. ``rows``: n_picks, dt."""
    hit = F.col("n_picks") > 0
    table = cut(rows.select(*by, hit.alias("_hit"), F.when(hit, F.col("dt")).alias("_dt")), "detection")
    out = table.groupBy(*by).agg(F.count("*").alias("windows"), F.count_if("_hit").alias("detections"))
    return with_keys(out, quantiles(table, by, "_dt", {"median_dt": 0.5}), by, "left").withColumn("rate", C.ratio(F.col("detections"), F.col("windows")))


def ablation(rows: DataFrame, pair: list[str], flag: str, value: str, by: list[str]) -> DataFrame:
    """Change of ``value`` between rows with and without ``flag`` of the same ``pair``, by group."""
    both = rows.groupBy(*pair, *by).agg(F.max(F.when(F.col(flag), F.col(value))).alias("_w"), F.max(F.when(~F.col(flag), F.col(value))).alias("_o")).where("_w IS NOT NULL AND _o IS NOT NULL")
    d = F.col("_w") - F.col("_o")
    return both.groupBy(*by).agg(F.count("*").alias("pairs"), F.avg(d).alias("mean_change"), F.count_if(d > 0).alias("better"), F.count_if(d < 0).alias("worse"), F.count_if(d == 0).alias("unchanged"))


def histogram(rows: DataFrame, column: str, low: float, high: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts in fixed bins of [low, high); values outside are left out."""
    inside = rows.where((F.col(column) >= low) & (F.col(column) < high))
    bin_ = F.floor((F.col(column) - low) / F.lit((high - low) / bins))
    return inside.groupBy(*(by or []), bin_.alias("bin")).agg(F.count("*").alias("n"))


def sp_check(pairs: DataFrame, within: float) -> DataFrame:
    """Paired picks, those within so many seconds of the prediction, and whether P is always first.
    ``pairs``: sp, predicted_sp."""
    return pairs.agg(
        F.count("sp").alias("paired"), F.count_if(F.abs(F.col("sp") - F.col("predicted_sp")) <= within).alias("close"), F.coalesce(F.bool_and(F.col("sp") > 0), F.lit(True)).alias("p_first")
    )


def implausible(first: DataFrame, observed: Column, expected: Column, pad: float) -> DataFrame:
    """First arrivals outside [0.5 expected, expected + pad]."""
    return first.where((observed < expected * 0.5) | (observed > expected + pad))


def label_changes(windows: DataFrame, by: list[str], order: str) -> DataFrame:
    """How often the label changes between consecutive windows, and the labels in order."""
    w = Window.partitionBy(*by).orderBy(order)
    change = (F.col("label") != F.lag("label").over(w)).cast("int")
    return windows.withColumn("_c", change).groupBy(*by).agg(F.count("*").alias("windows"), F.coalesce(F.sum("_c"), F.lit(0).cast("long")).alias("changes"), F.countDistinct("label").alias("labels"))
