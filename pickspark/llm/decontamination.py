"""Benchmark decontamination with suffix arrays over the training texts.

Each stretch of documents (a shard) gets a suffix array: its word positions, sorted by the words that
follow. Only suffixes that begin with as many words of the benchmark's vocabulary as a window has are
kept; no other can match. Every benchmark suffix is binary-searched in every shard, which gives all
places where its window occurs; each is then extended word by word to the longest verbatim match.
The shards are independent, so a lost executor costs only its own shards.

Words are what is left between ASCII characters other than letters and digits, A-Z lower-cased. A window is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window.

Edge cases: a null text has no words; an item without words never matches; equal items all count; a null
item id or text is left out; an empty benchmark leaves every document clean; an empty table gives no rows;
repeated rows are judged alike; extra columns of the documents stay, those named like an output are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, lean

#: UTF-8 bytes of benchmark text that are sent to the executors at a time; more takes more passes.
PASS_BYTES = 16 << 20
#: All ASCII characters other than letters and digits separate words.
TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))



def fields(item: T.DataType) -> list[T.StructField]:
    match = T.StructType([T.StructField("item_id", item), T.StructField("at", T.LongType()), T.StructField("length", T.LongType())])
    return [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", T.BinaryType()), T.StructField("matches", T.ArrayType(match))]


NAMES = ["n_words", "n_hit", "hits", "matches"]


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower() changes A-Z only; after the translation only spaces separate."""
    return (text or "").encode().lower().translate(TABLE).split()


@dataclass
class Items:
    """Benchmark items as word numbers; the windows by length, distinct, with where they come from."""

    ids: list  # numbers or texts
    number: dict[bytes, int]
    words: np.ndarray  # all items' words, 0 after each item
    windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # length, starts of distinct windows, group ends, (item, start) of each group

    @staticmethod
    def of(rows: list[tuple], window: int) -> Items:
        number: dict[bytes, int] = {}
        words, ids, begins = [], [], {}
        for item, text in rows:
            own = [number.setdefault(w, len(number) + 1) for w in words_of(text)]
            if own:
                length = min(window, len(own))
                begins.setdefault(length, []).extend((len(ids), len(words) + i) for i in range(len(own) - length + 1))
                ids.append(item)
                words += [*own, 0]
        flat = np.array(words, np.int32)
        found = []
        for length, at in sorted(begins.items()):
            from_ = np.array(at, np.int64)
            rows_ = np.lib.stride_tricks.sliding_window_view(flat, length)[from_[:, 1]]
            _, group = np.unique(rows_, axis=0, return_inverse=True)
            order = np.argsort(group.ravel(), kind="stable")
            ends = np.cumsum(np.bincount(group.ravel()))
            first = from_[order][np.concatenate([[0], ends[:-1]]), 1]
            found.append((length, first, ends, from_[order]))
        return Items(ids, number, flat, found)


def key(words: np.ndarray, starts: np.ndarray, length: int, most: int, fill: int = 0) -> np.ndarray:
    """Sortable keys: ``length`` words from each start (none beyond a 0), then ``fill`` up to ``most``."""
    at = starts[:, None] + np.arange(length)
    own = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)
    own[np.cumsum(own == 0, 1) > 0] = 0
    out = np.full((len(starts), most), fill, ">u4")
    out[:, :length] = own
    return out.view(f"S{4 * most}").ravel()


def search(texts: list[str | None], items: Items) -> list[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
    """For each text of a shard: number of words, which words are hit, and the longest match of each item."""
    get = items.number.get
    parts, sizes = [], []
    for t in texts:
        w = words_of(t)
        sizes.append(len(w))
        parts.append(np.fromiter((get(x, 0) for x in w), np.int32, len(w)))
        parts.append(np.zeros(1, np.int32))
    words = np.concatenate(parts) if parts else np.zeros(1, np.int32)
    begins = np.cumsum([0] + [s + 1 for s in sizes])
    cover = np.zeros(len(words) + 1, np.int64)
    longest: dict[tuple[int, int], tuple[int, int]] = {}
    if items.windows:
        most = items.windows[-1][0]
        zeros = np.flatnonzero(words == 0)
        run = zeros[np.searchsorted(zeros, np.arange(len(words)))] - np.arange(len(words))
        suffixes = np.flatnonzero(run >= items.windows[0][0])
        keys = key(words, suffixes, most, most) if len(suffixes) else np.zeros(0, f"S{4 * most}")
        order = np.argsort(keys, kind="stable")
        array, keys = suffixes[order], keys[order]  # the suffix array and what it is sorted by
        for length, first, ends, origin in items.windows:
            lo = np.searchsorted(keys, key(items.words, first, length, most), "left")
            hi = np.searchsorted(keys, key(items.words, first, length, most, 0xFFFFFFFF), "right")
            for w in np.flatnonzero(hi > lo).tolist():
                at = array[lo[w] : hi[w]]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                docs = np.searchsorted(begins, at, "right") - 1
                for item, start in origin[(ends[w - 1] if w else 0) : ends[w]].tolist():
                    size = np.full(len(at), length)
                    live = np.arange(len(at))
                    while len(live):  # extend to the longest verbatim match
                        x, y = at[live] + size[live], start + size[live]
                        live = live[(items.words[y] != 0) & (words[np.minimum(x, len(words) - 1)] == items.words[y])]
                        size[live] += 1
                    for d, p, s in zip(docs.tolist(), at.tolist(), size.tolist()):
                        if s > longest.get((d, item), (0, 0))[0]:
                            longest[d, item] = (s, p - int(begins[d]))
    hit = np.cumsum(cover) > 0
    by_doc: dict[int, list[tuple[int, int, int]]] = {}
    for (d, item), (s, p) in sorted(longest.items()):
        by_doc.setdefault(d, []).append((items.ids[item], p, s))
    return [(n, hit[b : b + n], by_doc.get(i, [])) for i, (n, b) in enumerate(zip(sizes, begins.tolist()))]


_items: dict[str, Items] = {}


def items_of(name: str, rows: list[tuple], window: int) -> Items:
    """A lot's items, made once in each Python worker; one lot is kept."""
    if name not in _items:
        _items.clear()
        _items[name] = Items.of(rows, window)
    return _items[name]


def passes(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The benchmark's items in lots of ``PASS_BYTES``; one lot at a time is held by the driver."""
    rows = benchmark.select(F.col(item_col), F.col(text_col)).where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    lot: list[tuple] = []
    held = 0
    for item, text in rows.toLocalIterator():
        if held > PASS_BYTES:
            yield lot
            lot, held = [], 0
        lot.append((item, text))
        held += len(text.encode())
    yield lot


def matches(df: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``hits`` (a bit for each word, little-endian) and ``matches``: the longest verbatim
    match of each item that has a window here, as item id (a number or a text), first word and number of words."""
    spark = df.sparkSession
    out = df.drop(*NAMES)
    base = out.schema.fields
    names = [f.name for f in base]
    whole = isinstance(benchmark.schema[item_col].dataType, T.IntegralType)
    benchmark = benchmark.withColumn(item_col, F.col(item_col).cast("long" if whole else "string"))
    schema = T.StructType([*base, *fields(T.LongType() if whole else T.StringType())])
    kinds = pa.list_(pa.struct([("item_id", pa.int64() if whole else pa.string()), ("at", pa.int64()), ("length", pa.int64())]))
    for nth, lot in enumerate(passes(benchmark, item_col, item_text_col)):
        sent = spark.sparkContext.broadcast(lot)  # PASS_BYTES at most, and its last item
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, nth=nth, name=name) -> Iterator[pa.RecordBatch]:
            items = items_of(name, sent.value, window)
            for batch in batches:
                for part in chunks(batch, text_col):
                    rows = search(part.column(text_col).to_pylist(), items)
                    hits = [np.packbits(h, bitorder="little").tobytes() for _, h, _ in rows]
                    found = [[{"item_id": i, "at": p, "length": s} for i, p, s in m] for _, _, m in rows]
                    if nth:
                        old = part.column("hits").to_pylist()
                        hits = [(np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes() for a, b in zip(hits, old)]
                        found = [a + b for a, b in zip(part.column("matches").to_pylist(), found)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(n) for n in names] + [pa.array([r[0] for r in rows], pa.int64()), pa.array([int(np.bitwise_count(np.frombuffer(h, np.uint8)).sum()) for h in hits], pa.int64()), pa.array(hits, pa.binary()), pa.array(found, kinds)],
                        names=[*names, *NAMES],
                    )

        out = out.mapInArrow(lean(run), schema)
    return out


def clean(df: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``df`` in which no window of the benchmark occurs."""
    own = {n: f"_own_{n}" for n in NAMES if n in df.columns}
    marked = matches(df.withColumnsRenamed(own), benchmark, window).where(F.size("matches") == 0)
    return marked.select(*(F.col(own.get(c, c)).alias(c) for c in df.columns))


def documents_against_benchmark(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    found = matches(documents.select("doc_id", "text"), benchmark, window)
    items = F.array_sort(F.transform(F.array_distinct(F.transform("matches", lambda m: m["item_id"])), lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )
