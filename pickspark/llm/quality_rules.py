"""Quality rules as a learned decision list, in DataFrame expressions only.

Statistics of whole texts are columns built from built-in functions. From labelled rows, sequential covering
grows conjunctions of thresholds (each condition by its information gain on two thirds of the rows, over all
borders between values that occur), prunes them on the other third, keeps a rule if it is precise there and
over all rows, and goes on with the rows not yet covered. What a rule that is not kept covers is set aside, and
growing goes on without it until no rule is left to grow. The list becomes one ordered ``CASE WHEN`` expression, which Spark evaluates with the statistics: no Python runs
on the executors, and nothing is shuffled but the labelled sample.

Learning uses at most ``MAX_LABELLED`` labelled rows (smallest hashed ids), a documented bound; only their
statistics reach the driver. Words are stretches without space, tab, line feed, vertical tab, form
feed and carriage return. Windows of three words are compared by 64-bit hashes, within one text only.

Edge cases: a null text counts as one without words (all statistics 0, base failed); texts of any length are
read whole; without labels the list is empty and keeps what passes the base rules; repeated rows are judged
alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

MAX_LABELLED = 20_000
#: Rules and conditions of a rule, at most; precision and rows a rule needs on the pruning rows.
RULES, CONDITIONS, PRECISION, LEAST = 12, 3, 0.95, 5

BLANK = r"[\x20\x09-\x0D]+"
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What rules may test, over the statistics.
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "cast(n_dup_lines as double)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "shout_share": "n_shouts / greatest(word_chars, 1)",
}


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once even where the optimizer moves the expression elsewhere."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more."""

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, k: x["h"].eqNullSafe(F.get(ordered, k - 1)["h"]) | x["h"].eqNullSafe(F.get(ordered, k + 1)["h"]))
        return F.aggregate(
            F.sort_array(F.transform(again, lambda x: x["i"])),
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
            lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(3), i - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    def of_windows(windows: Column) -> Column:
        # Only texts with a repeated window need their windows in order.
        twice = F.size(F.array_distinct(windows)) < F.size(windows)
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(twice, let(ordered, covered)).otherwise(F.lit(0))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, let(windows, of_windows)).otherwise(F.lit(0))


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base statistics, and counts of capitals A-Z and exclamation marks."""
    text = F.col("_text")
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    read = df.select(F.col(id_col), text_or_empty(text_col).alias("_text")).select(
        id_col,
        "_text",
        let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("again"))).alias("_words"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("_dup"),
    )
    return read.select(
        id_col,
        F.col("_words.n").cast("long").alias("n_words"),
        _without(text, BLANK).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.col("_dup").cast("long").alias("n_dup_lines"),
        F.col("_words.again").cast("long").alias("n_repeat_words"),
        (F.length(text) - _without(text, "[A-Z]")).cast("long").alias("n_capitals"),
        (F.length(text) - _without(text, "!")).cast("long").alias("n_shouts"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= threshold, else feature < threshold
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.above else '<'} {self.threshold!r}D"


def as_column(rules: list[list[Condition]]) -> Column:
    """The decision list: false for the rows of each rule in turn, else true."""
    whens = "".join(f" WHEN {' AND '.join(c.sql() for c in r)} THEN false" for r in rules)
    return F.expr(f"CASE{whens} ELSE true END" if rules else "true")


def learn(documents: DataFrame, labels: DataFrame, bad: str = "quality = 0", id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> list[list[Condition]]:
    """Rules for rows to reject, from ``labels`` (``bad``: SQL condition)."""
    marked = labels.select(F.col(id_col), F.expr(bad).alias("_bad")).dropna().groupBy(id_col).agg(F.max("_bad").alias("_bad"))
    sample = written(marked.orderBy(F.xxhash64(id_col), id_col).limit(max_labelled), "labelled")
    texts = documents.select(id_col, text_col).join(F.broadcast(sample.select(id_col)), id_col, "left_semi")  # max_labelled ids
    stats = statistics(texts, id_col, text_col).join(F.broadcast(sample), id_col)
    every = written(stats.select("_bad", F.expr(BASE_FAILED).alias("_failed"), (F.pmod(F.xxhash64(F.lit("prune"), F.col(id_col)), F.lit(3)) == 0).alias("_prune"), *(F.expr(sql).alias(f) for f, sql in FEATURES.items())), "statistics")
    table = every.where("NOT _failed")
    rows = table.select("_bad", "_prune", *FEATURES).toArrow()  # max_labelled rows of a number a feature
    column = lambda name: rows.column(name).to_numpy()
    return cover(column("_bad").astype(bool), column("_prune").astype(bool), {f: column(f) for f in FEATURES})


def cover(bad: np.ndarray, prune: np.ndarray, values: dict[str, np.ndarray]) -> list[list[Condition]]:
    """Sequential covering. Sets of rows are masks; ``values`` has each feature's value of each row."""
    order = {f: np.argsort(v, kind="stable") for f, v in values.items()}
    left, aside, rules = np.ones(len(bad), bool), np.zeros(len(bad), bool), []
    while len(rules) < RULES:
        rule, got = [], left & ~prune & ~aside
        while len(rule) < CONDITIONS and (got & ~bad).any():
            best = _best(bad, got, values, order)
            if best is None:
                break
            rule.append(best)
            got &= _meets(best, values)
        if not rule:
            break
        # Prune: the prefix that is most precise on rows it was not grown on.
        covered, prefixes = left, []
        for k, c in enumerate(rule, 1):
            covered = covered & _meets(c, values)
            held = covered & prune
            prefixes.append((_precision((held & bad).sum(), held.sum()), -k, covered))
        _, shorter, covered = max(prefixes, key=lambda x: x[:2])
        held = covered & prune
        n, k = held.sum(), (held & bad).sum()
        if k >= LEAST and k >= PRECISION * n and _precision((covered & bad).sum(), covered.sum()) >= PRECISION:
            rules.append(rule[:-shorter])
            left = left & ~covered
        else:
            aside |= got
    return rules


def _best(bad: np.ndarray, got: np.ndarray, values: dict[str, np.ndarray], order: dict[str, np.ndarray]) -> Condition | None:
    """The condition of the largest information gain among the rows ``got``, at any border between two values."""
    n, k = int(got.sum()), int((got & bad).sum())
    best, gained = None, 0.0
    for f, by in order.items():
        by = by[got[by]]
        v = values[f][by]
        at = np.flatnonzero(v[1:] > v[:-1]) + 1
        below = np.cumsum(bad[by])[at - 1]
        for above, hit, of in ((True, k - below, n - at), (False, below, at)):
            gain = hit * (np.log2(_precision(hit, of)) - np.log2(_precision(k, n)))
            if len(at) and gain.max() > gained:
                i = int(gain.argmax())
                low, high = float(v[at[i] - 1]), float(v[at[i]])
                middle = low + (high - low) / 2
                best, gained = Condition(f, above, middle if middle > low else high), float(gain[i])
    return best


def _meets(c: Condition, values: dict[str, np.ndarray]) -> np.ndarray:
    return values[c.feature] >= c.threshold if c.above else values[c.feature] < c.threshold


def _precision(hit: np.ndarray, of: np.ndarray) -> np.ndarray:
    """With two rows more, one of each kind."""
    return (hit + 1) / (of + 2)


def judged(documents: DataFrame, rules: list[list[Condition]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base statistics, ``base_failed`` and ``kept`` of each row."""
    failed = F.expr(BASE_FAILED)
    return statistics(documents, id_col, text_col).select(id_col, *BASE, failed.alias("base_failed"), (~failed & as_column(rules)).alias("kept"))


def documents_kept(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(documents, learn(documents, labels))
