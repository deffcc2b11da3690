"""One-to-one matching in time, and sequential suppression of duplicates.

Both are sequential by nature, but a gap longer than the tolerance separates what can interact. Times are cut
into such islands first, which are dealt over all tasks. A task streams its islands in order of time and
holds what can still interact: for matching the references of one tolerance and the candidates of two, for suppression
those of one tolerance for each priority and one more. An island without end costs time, not memory.

Matching goes in step over the chains (rows that interact) of many islands, and settles all levels of a sweep over the
same rows: a row has a bit for each level that it takes part in, and is not repeated for them.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.shared import cut
from .quantiles import quantiles, with_keys
from .scoring import at_weights

#: Rows that a task matches at once (more where more can interact), and so many chains at most are streamed one by one.
ROWS, ALONE = 50_000, 40
#: Levels of a sweep that go in one pass, as bits of a long.
LEVELS = 62


def islands(rows: DataFrame, keys: list[str], tol: float | str, time: str = "t") -> DataFrame:
    """Add ``island``: rows of one key whose neighbours in time are at most ``tol`` (seconds, or the key that has
    them) apart."""
    by = Window.partitionBy(*keys).orderBy(time)
    new = F.coalesce((F.col(time) - F.lag(time).over(by) > (F.col(tol) if isinstance(tol, str) else tol)).cast("int"), F.lit(0))
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def by_island(rows: DataFrame, keys: list[str], values: list[str], settler: Callable[[tuple], Matching | Suppression], schema: str) -> DataFrame:
    """What the settler of each island's key makes of its rows, in order of ``values``, as rows of ``schema``."""
    names = [*keys, "island", *values]
    out = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "int": pa.int32()}[f.split(" ")[1]] for f in schema.split(", ")]
    own = [out.index(k) for k in keys if k in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = itertools.chain.from_iterable(zip(*(b.column(n).to_pylist() for n in names)) for b in batches)
        made: list[tuple] = []
        for key, group in itertools.groupby(stream, lambda row: row[: len(keys) + 1]):
            settle, head = settler(key), key[: len(own)]
            for row in group:
                made += [(*head, *x) for x in settle.push(*row[len(keys) + 1 :])]
                if len(made) > 10_000:
                    yield batch(made)
                    made = []
            made += [(*head, *x) for x in settle.end()]
        if made:
            yield batch(made)

    def batch(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=out)

    dealt = rows.select(*names).repartition(*keys, "island").sortWithinPartitions(*keys, "island", *values)
    return dealt.mapInArrow(run, schema)


class Matching:
    """Each reference, in order of time, takes the nearest candidate within the tolerance that is not taken (the
    earlier of equal ones). Rows come in order of time; (reference id, candidate id, residual) come out once no later
    row can change them."""

    def __init__(self, tol: float):
        self.tol, self.peak = tol, 0
        self.references: deque[tuple[float, int]] = deque()
        self.candidates: deque[list] = deque()  # time, id, whether taken

    def push(self, t: float, i: int, side: int) -> list[tuple]:
        out = self._settle(t)
        if side == 0:
            self.references.append((t, i))
        else:
            self.candidates.append([t, i, False])
        self.peak = max(self.peak, len(self.references) + len(self.candidates))
        return out

    def end(self) -> list[tuple]:
        return self._settle(math.inf)

    def _settle(self, now: float) -> list[tuple]:
        out = []
        while self.references and self.references[0][0] + self.tol < now - 1e-9:
            t, i = self.references.popleft()
            out += self._passed(t)
            best = None
            for c in self.candidates:
                if c[0] > t + self.tol + 1e-9:
                    break
                if not c[2] and abs(c[0] - t) <= self.tol and (best is None or abs(c[0] - t) < abs(best[0] - t)):
                    best = c
            if best is not None:
                best[2] = True
            out.append((i, None, None) if best is None else (i, best[1], best[0] - t))
        return out + self._passed(self.references[0][0] if self.references else now)

    def _passed(self, t: float) -> list[tuple]:
        """Candidates that no reference from ``t`` on can reach."""
        out = []
        while self.candidates and self.candidates[0][0] < t - self.tol - 1e-9:
            _, i, taken = self.candidates.popleft()
            if not taken:
                out.append((None, i, None))
        return out


class Suppression:
    """Rows, in order of (priority, time, id), stay if none that stays is within the tolerance. They come in order of
    time; the ids of those that stay come out. A row is decided once all better ones within the tolerance are."""

    def __init__(self, tol: float):
        self.tol, self.peak, self.due = tol, 0, math.inf
        self.rows: deque[list] = deque()  # time, priority, id, whether it stays (None: open)

    def push(self, t: float, priority: object, i: int) -> list[tuple]:
        out = self._settle(t) if t > self.due else []
        self.due = min(self.due, t + self.tol)
        self.rows.append([t, priority, i, None])
        self.peak = max(self.peak, len(self.rows))
        return out

    def end(self) -> list[tuple]:
        return self._settle(math.inf)

    def _settle(self, now: float) -> list[tuple]:
        """Decide what has all its neighbours, better ones first; let go of what nothing open is near to."""
        out = []
        ready = sorted((r for r in self.rows if r[3] is None and r[0] + self.tol < now), key=lambda r: (r[1], r[0], r[2]))
        for row in ready:
            near = [r for r in self.rows if abs(r[0] - row[0]) <= self.tol and r is not row and (r[1], r[0], r[2]) < (row[1], row[0], row[2])]
            if any(r[3] for r in near):
                row[3] = False
            elif all(r[3] is False for r in near):
                row[3] = True
                out.append((row[2],))
        first = next((r[0] for r in self.rows if r[3] is None), now)
        while self.rows and self.rows[0][3] is not None and self.rows[0][0] < first - self.tol:
            self.rows.popleft()
        self.due = min((r[0] + self.tol for r in self.rows if r[3] is None and r[0] + self.tol >= now), default=math.inf)
        return out


def greedy(t: np.ndarray, ref: np.ndarray, new: np.ndarray, tol: np.ndarray) -> np.ndarray:
    """The candidate's row that each reference's row takes (as ``Matching`` has it), or -1. Rows are in order of time within
    groups, which begin where ``new``. The next reference of every chain is settled in one step; of the last few chains
    the rest is streamed."""
    n = len(t)
    taker = np.full(n, -1)
    if not n or ref.all() or not ref.any():
        return taker
    at = np.arange(n)
    group = np.cumsum(new)
    cut_ = new.copy()
    # Chains: no reference before a cut is near to a candidate behind it, nor the other way round.
    apart = np.ones(n - 1, bool)
    for one in (ref, ~ref):
        before = np.maximum.accumulate(np.where(one, at, -1))[:-1]
        after = np.minimum.accumulate(np.where(~one, at, n)[::-1])[::-1][1:]
        a, b = np.maximum(before, 0), np.minimum(after, n - 1)
        apart &= (before < 0) | (after == n) | (group[a] != group[b]) | (t[b] - t[a] > tol[a])
    cut_[1:] |= apart
    cut_[0] = True
    chain = np.cumsum(cut_) - 1
    # Free candidates are linked; 0 and the last place are ends.
    own = np.flatnonzero(~ref)
    when = np.concatenate([[-np.inf], t[own], [np.inf]])
    of = np.concatenate([[-1], chain[own], [-1]])
    places = np.arange(len(of))
    left, right = places - 1, places + 1
    left[1:][of[1:] != of[:-1]] = 0
    right[:-1][of[1:] != of[:-1]] = len(of) - 1
    taken = np.zeros(len(of), bool)
    refs = np.flatnonzero(ref)
    upto = np.cumsum(~ref)[refs]
    chains, first, count = np.unique(chain[refs], return_index=True, return_counts=True)
    some = np.bincount(of[1:-1], minlength=chain[-1] + 1)[chains] > 0
    order = np.argsort(-count[some], kind="stable")
    first, count = first[some][order], count[some][order]
    step, falling = 0, -count
    while (m := int(np.searchsorted(falling, -step, "left"))) > ALONE:
        i = first[:m] + step
        r, time, within = refs[i], t[refs[i]], tol[refs[i]]
        lo, hi = upto[i], upto[i] + 1
        lo, hi = np.where(of[lo] == chain[r], lo, 0), np.where(of[hi] == chain[r], hi, len(of) - 1)
        while len(j := np.flatnonzero(taken[lo])):
            lo[j] = left[lo[j]]
        while len(j := np.flatnonzero(taken[hi])):
            hi[j] = right[hi[j]]
        near, far = np.abs(when[lo] - time), np.abs(when[hi] - time)
        # Of candidates at one time the first.
        while len(j := np.flatnonzero((lo > 0) & (np.abs(when[left[lo]] - time) == near))):
            lo[j] = left[lo[j]]
        c = np.where(near <= far, lo, hi)
        hit = np.minimum(near, far) <= within
        c = c[hit]
        taker[r[hit]] = own[c - 1]
        taken[c] = True
        right[left[c]], left[right[c]] = right[c], left[c]
        step += 1
    for f, k in zip(first[:m].tolist(), count[:m].tolist()):
        rest, number = refs[f + step : f + k], chain[refs[f]]
        lo, hi = np.searchsorted(of[1:-1], [number, number + 1])
        free = own[lo:hi][~taken[lo + 1 : hi + 1]]
        rows = np.sort(np.concatenate([rest, free]))
        settle, out = Matching(float(tol[rest[0]])), []
        for x in zip(t[rows].tolist(), rows.tolist(), (~ref[rows]).astype(int).tolist()):
            out += settle.push(*x)
        for i, c, _ in out + settle.end():
            if i is not None and c is not None:
                taker[i] = c
    return taker


def matches(rows: DataFrame, keys: list[str], tols: list[float] | str, ref_id: str, cand_id: str, kept: list[str], level: str | None = None) -> DataFrame:
    """``kept`` of the keys, the level where it has a name, both ids and the residual. ``rows``: keys, ``t``, ``id``, ``side``, and
    ``levels``, whose bit ``i`` says whether a row takes part in level ``i``, of tolerance ``tols[i]``."""
    found = islands(rows.where("t IS NOT NULL AND levels != 0").withColumn("_reach", F.col(tols) if isinstance(tols, str) else F.lit(float(max(tols)))), keys + ["_reach"], "_reach")
    named = [f"`{k}` {dict(found.dtypes)[k].replace('bigint', 'long')}" for k in kept]
    schema = ", ".join([*named, *([f"`{level}` int"] if level else []), f"`{ref_id}` long", f"`{cand_id}` long", "residual double"])
    same, n_levels = [*keys, "island"], 1 if isinstance(tols, str) else len(tols)

    def settle(table: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
        """What no later row can change, and the rows that still count."""
        n = table.num_rows
        t, side, bits = (table.column(c).to_numpy() for c in ("t", "side", "levels"))
        reach = table.column("_reach").to_numpy()
        new = np.ones(n, bool)
        new[1:] = False
        for k in same:
            a = table.column(k).combine_chunks()
            null = a.is_null().to_numpy(zero_copy_only=False)
            other = pc.fill_null(pc.not_equal(a[1:], a[:-1]), False).to_numpy(zero_copy_only=False)
            new[1:] |= other | (null[1:] != null[:-1])
        group = np.cumsum(new)
        open_ = np.zeros(n, bool) if last else group == group[-1]
        each = [np.flatnonzero(bits >> j & 1) for j in range(n_levels)]
        at, number = np.concatenate(each), np.repeat(np.arange(n_levels), [len(e) for e in each])
        tol = reach[at] if isinstance(tols, str) else np.array(tols, float)[number]
        ref, time = side[at] == 0, t[at]
        wait = ref & open_[at] & ~(time + tol < t[-1] - 1e-9)
        go = np.flatnonzero(~wait)
        begins = np.ones(len(go), bool)
        begins[1:] = (np.diff(group[at[go]]) != 0) | (np.diff(number[go]) != 0)
        took = greedy(time[go], ref[go], begins, tol[go])
        is_ref = ref[go]
        used = np.zeros(len(go), bool)
        used[took[took >= 0]] = True
        free = go[~is_ref & ~used]
        # Candidates that a reference still to come, or one that waits, may reach.
        since = np.full(n_levels, t[-1])
        np.minimum.at(since, number[wait], time[wait])
        stays = open_[at[free]] & ~(time[free] < since[number[free]] - tol[free] - 1e-9)
        held = np.zeros(n, np.int64)
        for e in (np.flatnonzero(wait), free[stays]):
            np.bitwise_or.at(held, at[e], np.int64(1) << number[e])
        rest = np.flatnonzero(held)
        place = table.schema.get_field_index("levels")
        over = table.take(pa.array(rest)).set_column(place, table.schema.field(place), pa.array(held[rest]))

        r, c, extra = go[is_ref], took[is_ref], free[~stays]
        hit = c >= 0
        partner = np.where(hit, go[c], 0)
        row = np.concatenate([at[r], at[extra]])
        alone = np.repeat([False, True], [len(r), len(extra)])  # candidates without a reference
        of_hit = np.concatenate([hit, np.zeros(len(extra), bool)])
        ids = table.column("id").combine_chunks()
        columns = [table.column(k).combine_chunks().take(pa.array(row)) for k in kept]
        if level:
            columns.append(pa.array(np.concatenate([number[r], number[extra]]).astype(np.int32)))
        columns += [
            ids.take(pa.array(row, mask=alone)),
            ids.take(pa.array(np.concatenate([at[partner], at[extra]]), mask=~(of_hit | alone))),
            pa.array(np.concatenate([time[partner] - time[r], np.zeros(len(extra))]), mask=~of_hit),
        ]
        names = [*kept, *([level] if level else []), ref_id, cand_id, "residual"]
        return pa.Table.from_arrays(columns, names=names).to_batches(ROWS), over

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over, held, size = None, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= max(ROWS, over.num_rows if over else 0):
                out, over = settle(pa.concat_tables([*([over] if over else []), pa.Table.from_batches(held)]), False)
                held, size = [], 0
                yield from out
        tables = [*([over] if over else []), *([pa.Table.from_batches(held)] if held else [])]
        if sum(x.num_rows for x in tables):
            yield from settle(pa.concat_tables(tables), True)[0]

    names = [*dict.fromkeys([*same, "_reach", "t", "id", "side", "levels"])]
    return found.select(*names).repartition(*same).sortWithinPartitions(*same, "t", "id", "side").mapInArrow(run, schema)


def sides(reference: DataFrame, candidates: DataFrame, keys: list[str], levels: tuple[Column, Column], ref_time: str = "time", cand_time: str = "peak", ref_id: str = "arrival_id", cand_id: str = "pick_id") -> DataFrame:
    """The rows of both sides, as ``matches`` takes them."""
    part = lambda df, time, i, side: df.select(*keys, C.epoch_seconds(F.col(time)).alias("t"), F.col(i).cast("long").alias("id"), F.lit(side).alias("side"), levels[side].cast("long").alias("levels"))
    return part(reference, ref_time, ref_id, 0).unionByName(part(candidates, cand_time, cand_id, 1))


def match(reference: DataFrame, candidates: DataFrame, keys: list[str], tol: float | str, ref_time: str = "time", cand_time: str = "peak", ref_id: str = "arrival_id", cand_id: str = "pick_id") -> DataFrame:
    """``keys``, ``ref_id``, ``cand_id`` and ``residual`` (candidate - reference seconds): a row for each reference
    (candidate null if unmatched), and one for each unused candidate (reference null). ``tol``: seconds, or the key that has them."""
    rows = sides(reference, candidates, keys, (F.lit(1), F.lit(1)), ref_time, cand_time, ref_id, cand_id)
    return matches(rows, keys, tol if isinstance(tol, str) else [tol], ref_id, cand_id, keys)


def match_levels(reference: DataFrame, candidates: DataFrame, keys: list[str], levels: list[float], passes: Callable[[float], Column], tol: Callable[[float], float], kept: list[str], name: str) -> DataFrame:
    """As ``match`` at each level, in one pass over the rows: ``passes`` says of a candidate whether it takes part. Of the keys
    only those in ``kept`` come out, with the level as ``name``."""
    found = []
    for i in range(0, len(levels), LEVELS):
        some = levels[i : i + LEVELS]
        bits = functools.reduce(Column.bitwiseOR, [F.when(passes(x), F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long")) for j, x in enumerate(some)])
        rows = sides(reference, candidates, keys, (F.lit((1 << len(some)) - 1), bits))
        one = matches(rows, keys, [tol(x) for x in some], "arrival_id", "pick_id", kept, "_level")
        found.append(one.withColumn(name, F.get(F.array(*map(F.lit, some)), F.col("_level"))).drop("_level"))
    return functools.reduce(DataFrame.unionByName, found)


def score(matched: DataFrame, keys: list[str], ref_id: str = "arrival_id", cand_id: str = "pick_id", bias: bool = True) -> DataFrame:
    """Analyst picks, matches, recall, mean absolute and (with ``bias``) median residual, and extra picks, by ``keys``."""
    hit = F.col(ref_id).isNotNull() & F.col(cand_id).isNotNull()
    table = matched.select(*keys, F.col(ref_id).isNotNull().alias("_ref"), F.when(hit, F.col("residual")).alias("residual"))
    table = cut(table, "matched") if bias else table
    out = table.groupBy(*keys).agg(
        F.count_if("_ref").alias("analyst"),
        F.count("residual").alias("matched"),
        F.avg(F.abs("residual")).alias("mae"),
        F.count_if(~F.col("_ref")).alias("extra"),
    )
    out = with_keys(out, quantiles(table, keys, "residual", {"bias": 0.5}), keys, "left") if bias else cut(out, "scores")
    return out.withColumn("recall", C.ratio(F.col("matched"), F.col("analyst")))


def suppress(picks: DataFrame, keys: list[str], tol: float, priority: str, time: str = "peak", id_col: str = "pick_id") -> DataFrame:
    """Drop a pick within ``tol`` seconds of one already kept; the archive with the smaller ``priority`` comes
    first, then time."""
    rows = islands(picks.withColumn("seconds", C.epoch_seconds(F.col(time))), keys, tol, "seconds")

    keep_ids = by_island(rows.withColumn("first", F.col(priority)), keys, ["seconds", "first", id_col], lambda key: Suppression(tol), f"`{id_col}` long")
    return picks.join(keep_ids, id_col, "left_semi")


def agreement(picks: DataFrame, weights: list[str], keys: list[str], tol: float) -> DataFrame:
    """For each pair of models the share of the first one's picks that the second matches, all pairs in one pass."""
    pairs = [(a, b) for i, a in enumerate(weights) for b in weights[i + 1 :]]
    listed = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    of = lambda side: picks.withColumn("_pair", F.explode(F.filter(listed, lambda p: p[side] == F.col("weight")))).withColumns({"a": F.col("_pair.a"), "b": F.col("_pair.b")})
    first = of("a").select("a", "b", *keys, F.col("peak").alias("time"), F.col("pick_id").alias("arrival_id"))
    return score(match(first, of("b"), ["a", "b", *keys], tol), ["a", "b"], bias=False).select("a", "b", F.col("analyst").alias("n"), "matched", F.col("recall").alias("agreement"))


def sweep(reference: DataFrame, picks: DataFrame, thresholds: list[float], keys: list[str], tol: float, bias: bool = True) -> DataFrame:
    """Recall and emitted picks at each threshold, in one job."""
    found = match_levels(reference, picks, keys, thresholds, lambda x: F.col("conf") >= x, lambda _: tol, [], "threshold")
    return score(found, ["threshold"], bias=bias).withColumn("emitted", F.col("matched") + F.col("extra"))


def model_sweep(reference: DataFrame, picks: DataFrame, thresholds: list[float], keys: list[str], tol: float, by: list[str], least: int = 20, bias: bool = True) -> DataFrame:
    """As ``sweep``, for each model (``weight``) and group ``by``, in one job. Groups with fewer than ``least`` analyst
    picks say nothing and have no row."""
    ref = at_weights(reference, picks.select("weight").distinct())
    kept = ["weight", *by]
    found = match_levels(ref, picks, ["weight", *keys], thresholds, lambda x: F.col("conf") >= x, lambda _: tol, kept, "threshold")
    return score(found, ["weight", "threshold", *by], bias=bias).where(F.col("analyst") >= least).withColumn("emitted", F.col("matched") + F.col("extra"))


def tolerance_sweep(reference: DataFrame, picks: DataFrame, tols: list[float], keys: list[str]) -> DataFrame:
    """Scores at each tolerance, in one job."""
    found = match_levels(reference, picks, keys, tols, lambda _: F.lit(True), lambda x: x, [], "tol")
    return score(found, ["tol"])
