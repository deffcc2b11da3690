"""Toxicity by classifier chains.

Categories are predicted one after the other by logistic models over word features; each later model also
sees the earlier categories' probabilities, and is trained with out-of-fold ones, so that it meets at training
what it will meet at scoring. The ``labels`` table has two categories, low quality and toxic; the chain runs in
that order and takes any list of categories.

Features are a text's distinct words, the first four and five letters of longer words (a slur's inflections
share them), and runs of symbols. Which of them the models see is chosen by their counts over the labelled
rows. Training uses at most ``MAX_LABELLED`` labelled rows (those of smallest hashed id), a documented bound; with
at most ``FEATURES`` features the training table that the driver holds is bounded, whatever the corpus. Scoring
covers whole texts of all rows and shuffles nothing.

The threshold of a category is chosen from the out-of-fold probabilities.

Edge cases: a null or empty text has no features and gets the models' base rates; without labels, or with
one class only, a category's probability is that class's share (0 without labels); repeated rows get equal
scores; of labels of one id that differ the larger counts; each category is trained on the rows where its own label is not null, and labels whose document is
missing are not used; an empty table gives no rows; other
columns pass through, those named like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, lean, written

MAX_LABELLED = 10_000
FEATURES = 2048
#: A feature counts if so many labelled rows have it.
LEAST_ROWS = 5
FOLDS, STEPS, RIDGE = 4, 160, 2e-4
MEMO = 300_000
TOKENS = re.compile(r"[^\W\d_]+|[^\w\s]{2,}|\|")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]


def features(text: str | None) -> set[str]:
    return {f for w in set(TOKENS.findall((text or "").lower())) for f in word_features(w)}


@dataclass
class Linear:
    """A logistic model over features and earlier categories' probabilities."""

    bias: float
    weights: np.ndarray
    earlier: np.ndarray


@dataclass
class Chain:
    categories: list[str]
    vocabulary: dict[str, int]
    models: list[Linear]
    accuracy: list[float] = field(default_factory=list)  # out of fold
    thresholds: list[float] = field(default_factory=list)  # likewise

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """Probabilities, a column for each category."""
        out = np.zeros((len(rows), 0))
        sizes = [len(r) for r in rows]
        at = np.repeat(np.arange(len(rows)), sizes)
        flat = np.fromiter((i for r in rows for i in r), np.int64, sum(sizes))
        for m in self.models:
            z = m.bias + np.bincount(at, m.weights[flat], len(rows)) + out @ m.earlier
            out = np.column_stack([out, 1 / (1 + np.exp(-np.clip(z, -40, 40)))])
        return out


def fit(flat: np.ndarray, at: np.ndarray, n: int, width: int, extra: np.ndarray, y: np.ndarray, rows: np.ndarray) -> Linear:
    """Accelerated gradient descent on the ridge-penalised log loss of ``rows`` (a mask)."""
    share = float(y[rows].mean()) if rows.any() else 0.0
    if share in (0.0, 1.0):
        return Linear(40.0 if share else -40.0, np.zeros(width), np.zeros(extra.shape[1]))
    used = rows[at]
    flat, at = flat[used], at[used]
    m = int(rows.sum())
    w, e, b = np.zeros(width), np.zeros(extra.shape[1]), float(np.log(share / (1 - share)))
    # Rare features take longer steps: each is scaled by how often it occurs.
    often = np.bincount(flat, minlength=width) / m
    rate = 0.5 / np.sqrt(often + 1e-4)
    velocity = [np.zeros(width), np.zeros(extra.shape[1]), 0.0]
    for _ in range(STEPS):
        ahead = [x + 0.9 * v for x, v in zip((w, e, b), velocity)]
        z = ahead[2] + np.bincount(at, ahead[0][flat], n) + extra @ ahead[1]
        gap = np.where(rows, 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y, 0.0) / m
        steps = [rate * (np.bincount(flat, gap[at], width) + RIDGE * ahead[0]), extra.T @ gap + RIDGE * ahead[1], gap.sum()]
        velocity = [0.9 * v - s for v, s in zip(velocity, steps)]
        w, e, b = (x + v for x, v in zip((w, e, b), velocity))
    return Linear(float(b), w, e)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold from which rows count as positive that has the largest F1 score; of equal ones the one in the widest
    gap, between the scores on its sides. Above all scores if there are no positive rows."""
    if not len(y) or not y.any():
        return 2.0
    order = np.argsort(p, kind="stable")
    z = np.log(np.clip(p[order], 1e-12, 1 - 1e-12)) - np.log1p(-np.clip(p[order], 1e-12, 1 - 1e-12))
    first = np.flatnonzero(np.concatenate([[True], z[1:] > z[:-1]]))
    hits = y.sum() - np.concatenate([[0], np.cumsum(y[order])])[first]
    f1 = 2 * hits / (len(y) - first + y.sum())
    gap = z[first] - np.concatenate([[z[0] - 1], z[first[1:] - 1]])
    best = max(range(len(first)), key=lambda i: (f1[i], gap[i]))
    return float(1 / (1 + np.exp(-(z[first[best]] - gap[best] / 2))))


def train_chain(rows: list[list[int]], labels: np.ndarray, categories: list[str], vocabulary: dict[str, int]) -> Chain:
    n, width = len(rows), len(vocabulary)
    sizes = [len(r) for r in rows]
    at = np.repeat(np.arange(n), sizes)
    flat = np.fromiter((i for r in rows for i in r), np.int64, sum(sizes))
    fold = np.random.default_rng(7).permutation(n) % FOLDS
    chain = Chain(categories, vocabulary, [])
    earlier = np.zeros((n, 0))
    for c in range(len(categories)):
        y = labels[:, c].astype(float)
        known = ~np.isnan(y)
        held_out = np.zeros(n)
        for k in range(FOLDS):
            m = fit(flat, at, n, width, earlier, y, known & (fold != k))
            z = m.bias + np.bincount(at, m.weights[flat], n) + earlier @ m.earlier
            held_out = np.where(fold == k, 1 / (1 + np.exp(-np.clip(z, -40, 40))), held_out)
        chain.models.append(fit(flat, at, n, width, earlier, y, known))
        chain.accuracy.append(float(((held_out > 0.5) == (y > 0.5))[known].mean()) if known.any() else 1.0)
        chain.thresholds.append(best_threshold(held_out[known], y[known]))
        earlier = np.column_stack([earlier, held_out])
    return chain


def learn(documents: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, most_features: int = FEATURES) -> Chain:
    """Train a chain. ``categories``: name and SQL condition over ``labels``, in the order of the chain."""
    names = list(categories)
    ys = [f"_y{i}" for i in range(len(names))]
    each = labels.select(F.col(id_col), *(F.expr(sql).cast("int").alias(y) for y, sql in zip(ys, categories.values())))
    marked = each.dropna(subset=[id_col]).groupBy(id_col).agg(*(F.max(y).alias(y) for y in ys)).dropna("all", subset=ys)
    sample = marked.orderBy(F.xxhash64(id_col), id_col).limit(max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                found = [sorted(features(t)) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(f"_y{i}") for i in range(len(names))), pa.array(found, pa.list_(pa.string()))], names=[*(f"_y{i}" for i in range(len(names))), "features"])

    # The sample is bounded, so it may be sent everywhere instead of shuffling texts.
    picked = documents.select(F.col(id_col), F.col(text_col)).join(F.broadcast(written(sample, "labelled")), id_col).drop(id_col)
    rows = written(picked.mapInArrow(lean(run), ", ".join(f"_y{i} int" for i in range(len(names))) + ", features array<string>"), "features")
    sums = rows.agg(F.count("*").alias("n"), *(F.count(y).alias(f"n{y}") for y in ys), *(F.sum(y).alias(y) for y in ys)).first()
    if not sums["n"]:
        return train_chain([], np.zeros((0, len(names))), names, {})
    counted = rows.select(F.explode("features").alias("feature"), *ys).groupBy("feature").agg(*(F.count(y).alias(f"k{y}") for y in ys), *(F.sum(y).alias(y) for y in ys))
    vocabulary: dict[str, int] = {}
    for y in ys:
        if not sums[f"n{y}"]:
            continue
        expected = F.col(f"k{y}") * (sums[y] / sums[f"n{y}"])
        strength = F.abs(F.col(y) - expected) / F.sqrt(expected + 1)
        for r in counted.where(F.col(f"k{y}") >= LEAST_ROWS).select("feature", strength.alias("_s")).orderBy(F.desc("_s"), "feature").limit(most_features // len(names)).collect():
            vocabulary.setdefault(r.feature, len(vocabulary))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array([vocabulary[f] for f in fs if f in vocabulary], np.int32).tobytes() for fs in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f"_y{i}") for i in range(len(names))), pa.array(found, pa.binary())], names=[*(f"_y{i}" for i in range(len(names))), "f"])

    # MAX_LABELLED rows of at most FEATURES numbers; as measured, some hundred each.
    table_rows = rows.mapInArrow(numbered, ", ".join(f"_y{i} int" for i in range(len(names))) + ", f binary").collect()
    order = sorted(table_rows, key=lambda r: (bytes(r.f), *(-1 if y is None else y for y in r[:-1])))
    return train_chain([np.frombuffer(bytes(r.f), np.int32).tolist() for r in order], np.array([[np.nan if y is None else y for y in r[:-1]] for r in order], float), names, vocabulary)


def score(df: DataFrame, chain: Chain, text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """Add the probability of each category."""
    outs = [prefix + c for c in chain.categories]
    base = [f for f in df.schema.fields if f.name not in outs]
    names = [f.name for f in base]
    sent = df.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights a category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        get, memo = model.vocabulary.get, {}

        def of(word: str) -> tuple[int, ...]:
            if (found := memo.get(word)) is None:
                if len(memo) > MEMO:
                    memo.clear()
                found = memo[word] = tuple(i for f in word_features(word) if (i := get(f)) is not None)
            return found

        for batch in batches:
            for part in chunks(batch, text_col):
                rows = []
                for t in part.column(text_col).to_pylist():
                    got: set[int] = set()
                    got.update(*map(of, set(TOKENS.findall((t or "").lower()))))
                    rows.append(sorted(got))
                p = model.scores(rows)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *(pa.array(p[:, i]) for i in range(len(outs)))], names=[*names, *outs])

    return df.select(*names).mapInArrow(lean(run), T.StructType([*base, *(T.StructField(o, T.DoubleType()) for o in outs)]))


#: The chain over the ``labels`` table.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def judged(documents: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """``documents`` with ``p_low_quality``, ``p_toxic`` and ``is_toxic``: whether ``p_toxic`` reaches the threshold, by
    default that of the largest F1 score of the training rows out of fold."""
    chain = learn(documents, labels, CATEGORIES)
    return score(documents, chain).withColumn("is_toxic", F.col("p_toxic") >= (chain.thresholds[-1] if threshold is None else threshold))
