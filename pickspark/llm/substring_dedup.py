"""Substring deduplication by recompression: words covered by a window of words that also occurs earlier are removed.

1. *Rounds.* A word's name is a hash of its bytes. A round joins runs of equal symbols, the others join the pairs of
   neighbours whose coins (a bit of the name) are 0 and 1; the new symbol's name is a hash of the names it joins. All
   tasks give the same run or pair the same name, without a dictionary. Whether a border between two symbols stays
   depends on the words of a few symbols around it only, its *context*, whose reach is kept for every border. So equal
   stretches have equal symbols inside, wherever they stand.
2. *Units.* Of the borders whose context lies in a window, the window takes one by the hash of the two symbols beside it:
   a choice by the window's words alone. Neighbouring windows that take the same border form a unit, some six windows.
   Equal windows are in units of one border name, at one offset from the border.
3. *Shared symbols.* Units meet by border name. A unit whose words, all of them, occur in an earlier unit of the name is
   removed. A name with units of different words (where a repeated passage begins or ends) needs its windows looked at.
4. *Verification.* Those windows meet by the hash of their 20 words; all but the earliest are removed.
5. What is to be removed meets the texts.

Names that decide have 128 bits, two chains of a mixing step that is bijective in each part and not linear: no two
words of up to eight bytes share a name, and no arrangement of repeated words cancels out as in a sum. The chance that
any two of 10^12 names meet is below 10^-14.

Units and windows go to tasks in packed blobs by the name; in a task's lot, equal ones go once, so copies cost what one
costs. Names that a sample finds frequent are dealt by unit instead of by name. The names of step 3 go back to the
documents as a bitmap of at most ``FILTER_BITS`` bits; what it lets through by mistake is merely looked at.

Edge cases: a null or empty text has no words; a text of fewer words than a window keeps them; words are what is
between white space (space, tab, line feed, vertical tab, form feed, carriage return); very long texts are read in
pieces; a window that overlaps itself counts as starting earlier; a null id comes before all others; texts that share
an id are ordered by their hashes, and rows with equal id and text are judged alike; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .hashing import PAD, U, joined, mix, word_names

WINDOW = 20
#: Rounds of pairs after the round of runs; longer pairs than PAIR words are not joined.
ROUNDS, PAIR = 3, 10
#: Bytes that are parsed at a time, and of a piece of a text.
BLOCK_BYTES, PIECE_BYTES = 2 << 20, 2 << 20
#: Units or windows that a task gathers before they go out in blobs.
LOT = 1_000_000
#: UTF-8 bytes of text for each bucket of units and of texts.
BUCKET_BYTES = 12 << 20
#: The largest filter (32 MB), bits for each name in it, and bits of a page of it.
FILTER_BITS, BITS_EACH, PAGE = 1 << 28, 16, 1 << 16
#: Documents that are sampled for frequent names, and the share of them that makes a name frequent.
SAMPLED, FREQUENT = 10_000, 1 / 500
#: The most frequent names that are dealt by unit.
MOST_FREQUENT = 20_000
SPACE = re.compile(rb"[\x20\x09-\x0d]")
NULL_ID = -(1 << 63)

RECORD = "kind int, bucket int, n int, k binary, f binary, docs binary, versions binary, at binary, sizes binary"
UNITS, REMOVED, NAMES = 0, 1, 2


def packed(x: np.ndarray, kind: str) -> bytes:
    """Differences of neighbours, compressed."""
    with np.errstate(over="ignore"):
        return zstandard.compress(np.diff(x.astype(kind), prepend=np.zeros(1, kind)).tobytes(), 3)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(np.frombuffer(zstandard.decompress(data), kind), dtype=kind)


def prime(least: int) -> int:
    n = max(2, least)
    while any(n % i == 0 for i in range(2, int(n**0.5) + 1)):
        n += 1
    return n


# -- parsing ----------------------------------------------------------------------------------------------------------


@dataclass
class Parse:
    """Units of a block: first and last start, border, border name and unit name; and the names of words."""

    first: np.ndarray
    last: np.ndarray
    k: np.ndarray
    f: np.ndarray
    lane: np.ndarray
    windows: np.ndarray  # second name of the window from each start

    def window_names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return folded(self.lane, at), self.windows[at]


def folded(lane: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First names of the windows from some starts."""
    h = np.zeros(len(at), U)
    for i in range(WINDOW):
        h = joined(h, lane[at + i])
    return h


def doubled(lane: np.ndarray) -> np.ndarray:
    """A name of the window from every start that has one, from those of 1, 2, 4, 8 and 16 words."""
    parts, size, h = [], 1, lane
    while True:
        if WINDOW & size:
            parts.append((size, h))
        if size * 2 > WINDOW:
            break
        h, size = joined(h[:-size], h[size:]), size * 2
    n = len(lane) - WINDOW + 1
    out, done = None, 0
    for size, h in reversed(parts):
        own = h[done : done + n]
        out, done = own if out is None else joined(out, own), done + size
    return out


def recompressed(lane: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Borders that the last round leaves, their names (of the two symbols that the last round has compared there), and
    the contexts' first and last words. ``bounds``: where pieces of texts begin, and the end; no symbol reaches over one."""
    far = 1 << 40
    cut, name = np.arange(len(lane) + 1), lane
    lo, hi = cut.copy(), cut.copy()
    fixed = np.zeros(len(cut), bool)
    fixed[bounds] = True  # between words like any other, but no round removes it, whatever stands beside it
    for nth in range(ROUNDS + 1):
        if nth == 0:
            gone = name[:-1] == name[1:]
        else:
            size, coin = np.diff(cut), (mix(name + U(nth)) & U(1)).astype(bool)
            gone = ~coin[:-1] & coin[1:] & (size[:-1] + size[1:] <= PAIR)
        gone = np.concatenate([[False], gone, [False]]) & ~fixed
        stays = np.flatnonzero(~gone)
        beside = np.concatenate([name[:1], joined(name[:-1], name[1:]), name[-1:]])[stays] if nth == ROUNDS else None
        # What a border rests on is what its neighbours of this round rest on.
        lo[1:], hi[:-1] = lo[:-1].copy(), hi[1:].copy()
        lo[fixed], hi[fixed] = -far, far
        at, parts = stays[:-1], np.diff(stays)
        several = parts > 1
        old, name = name, name[at]
        if nth == 0:
            name[several] = joined(name[several], parts[several].astype(U))
        else:
            name[several] = joined(name[several], old[at[several] + 1])
        cut, lo, hi, fixed = cut[stays], lo[stays], hi[stays], fixed[stays]
    return cut, beside, lo, hi


def chosen(n: int, cut: np.ndarray, rank: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For the window from each of ``n`` starts how many words before its border it begins, or 255."""
    size = n + WINDOW
    order, left, right = np.zeros(size + 1, np.uint32), np.full(size + 1, 255, np.uint8), np.full(size + 1, 255, np.uint8)
    order[cut] = rank | np.uint32(1 << 31)
    left[cut], right[cut] = np.minimum(cut - lo, 255), np.minimum(hi - cut, 255)
    out = np.zeros(n, np.uint32)
    for at in range(0, n, 1 << 15):
        m = min(1 << 15, n - at)
        best = out[at : at + m]
        for j in range(WINDOW + 1):
            fits = (left[at + j : at + j + m] <= j) & (right[at + j : at + j + m] <= WINDOW - j)
            np.maximum(best, (order[at + j : at + j + m] & np.uint32(~31 & 0xFFFFFFFF) | np.uint32(j)) * fits, out=best)
    return np.where(out > 0, out & np.uint32(31), np.uint32(255)).astype(np.uint8)


def parsed(one: np.ndarray, two: np.ndarray, bounds: np.ndarray) -> Parse:
    """Units of all windows of a block. ``one``, ``two``: both names of its words."""
    none = np.zeros(0, np.int64)
    n = len(one) - WINDOW + 1
    if n <= 0:
        return Parse(none, none, none.astype(U), none.astype(U), one, none.astype(U))
    windows = doubled(two)
    ends = bounds[np.searchsorted(bounds, np.arange(n), "right")]
    real = np.arange(n) + WINDOW <= ends
    cut, beside, lo, hi = recompressed(one, bounds)
    names = np.zeros(len(one) + 1, U)
    names[cut] = beside
    rank = (mix(beside + U(1)) >> U(33)).astype(np.uint32)
    j = chosen(n, cut, rank, lo, hi)
    border = np.arange(n) + j
    own = j == 255
    border[own] = -1
    new = np.ones(n, bool)
    new[1:] = (border[1:] != border[:-1]) | own[1:] | ~real[:-1]
    first = np.flatnonzero(new & real)
    stops = np.append(np.flatnonzero(new | ~real), n)
    last = stops[np.searchsorted(stops, first, "right")] - 1
    k = np.zeros(len(first), U)
    alone = own[first]
    k[alone] = folded(one, first[alone])
    k[~alone] = names[border[first[~alone]]]
    offsets = (j[first].astype(U) << U(8)) + j[last].astype(U)
    return Parse(first, last, k, joined(joined(windows[first], windows[last]), offsets), one, windows)


@dataclass
class Block:
    """Pieces of texts: document, version and text of each, and the place of its first word in the whole text."""

    docs: list[int]
    versions: list[int]
    places: list[int]
    texts: list[bytes]

    def named(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both names of all words, and where the pieces begin among them, with the end."""
        begin, (one, two) = word_names(np.frombuffer(b"\n".join([*self.texts, PAD]), np.uint8), 2)
        starts = np.cumsum([0, *(len(t) + 1 for t in self.texts)])
        return one, two, np.searchsorted(begin, starts)


def pieces(text: bytes) -> Iterator[bytes]:
    """A text, cut at white space."""
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            found = SPACE.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block, held = Block([], [], [], []), 0
    for batch in batches:
        for doc, version, text in zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist(), batch.column("text")):
            text = text.as_py() or b""
            for place, part in [(0, text)] if len(text) <= PIECE_BYTES else overlapping(text):
                if len(part) < 2 * WINDOW - 1:  # too short for a window
                    continue
                block.docs.append(doc)
                block.versions.append(version)
                block.places.append(place)
                block.texts.append(part)
                held += len(part)
                if held > BLOCK_BYTES:
                    yield block
                    block, held = Block([], [], [], []), 0
    yield block


def overlapping(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of a long text, each after the words of the windows that the one before could not finish, and the places
    of their first words."""
    tail, place = [], 0
    for part in pieces(text):
        words = tail + part.split()
        if len(words) >= WINDOW:
            yield place, b" ".join(words)
            place += len(words) - WINDOW + 1
            words = words[len(words) - WINDOW + 1 :]
        tail = words


# -- lots -------------------------------------------------------------------------------------------------------------


@dataclass
class Spans:
    """Units or windows: names, document, version, first start, and how many further windows."""

    k: np.ndarray
    f: np.ndarray
    doc: np.ndarray
    version: np.ndarray
    at: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(parts: list[Spans]) -> Spans:
        return Spans(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("k", "f", "doc", "version", "at", "size")))

    def __getitem__(self, at: np.ndarray) -> Spans:
        return Spans(self.k[at], self.f[at], self.doc[at], self.version[at], self.at[at], self.size[at])

    def __len__(self) -> int:
        return len(self.k)

    def settled(self) -> tuple[Spans, Spans, np.ndarray]:
        """The earliest of each name pair, in order of names; those that start later; which of the earliest share k."""
        x = self[np.lexsort((self.at, self.version, self.doc, self.f, self.k))]
        new = np.ones(len(x), bool)
        new[1:] = (x.k[1:] != x.k[:-1]) | (x.f[1:] != x.f[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(x) else np.zeros(0, np.int64)
        later = (x.doc != x.doc[head]) | (x.version != x.version[head]) | (x.at != x.at[head])
        firsts = x[new]
        same = np.concatenate([[False], firsts.k[1:] == firsts.k[:-1]]) if len(firsts) else np.zeros(0, bool)
        shared = same | np.append(same[1:], False) if len(firsts) else same
        return firsts, x[later], shared

    def blobs(self, kind: int, bucket: np.ndarray, names: bool) -> Iterator[pa.RecordBatch]:
        if not len(self):
            return
        order = np.lexsort((self.at, self.version, self.doc, bucket))
        x, bucket = self[order], bucket[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        rows = []
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = slice(i, j)
            rows.append((kind, int(bucket[i]), j - i, x.k[own].tobytes() if names else None, x.f[own].tobytes() if names else None, packed(x.doc[own], "<i8"), packed(x.version[own], "<i8"), packed(x.at[own], "<i8"), packed(x.size[own], "<i2")))
        yield records(rows)

    @staticmethod
    def unpacked(rows: list[dict]) -> Spans:
        return Spans.of([Spans(*((np.frombuffer(r[n], "<u8") if r[n] is not None else np.zeros(r["n"], U)) for n in "kf"), unpacked(r["docs"], "<i8"), unpacked(r["versions"], "<i8"), unpacked(r["at"], "<i8"), unpacked(r["sizes"], "<i2")) for r in rows])


KINDS = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), KINDS)], names=COLUMNS)


@dataclass
class Plan:
    """Numbers of buckets, and names that are dealt by unit (sorted)."""

    units: int
    texts: int
    frequent: np.ndarray

    def bucket(self, spans: Spans) -> np.ndarray:
        by = np.where(listed(spans.k, self.frequent), spans.f, spans.k)
        return (mix(by) % U(self.units)).astype(np.int64)

    def text_bucket(self, doc: np.ndarray, version: np.ndarray) -> np.ndarray:
        return (doc % self.texts + version % self.texts) % self.texts


def listed(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``table``."""
    if not len(table):
        return np.zeros(len(x), bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def in_filter(k: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = mix(k + U(2)) & U(len(bits) * 8 - 1)
    return (bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1


def gathered(batches: Iterator[pa.RecordBatch], plan: Plan, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Units of the documents, or the windows of those units whose border name is in the filter ``bits``, in lots:
    the earliest of a lot go to their buckets, the others are removed."""
    held: list[Spans] = []

    def out() -> Iterator[pa.RecordBatch]:
        firsts, later, _ = Spans.of(held).settled()
        held.clear()
        yield from firsts.blobs(UNITS, plan.bucket(firsts), True)
        yield from later.blobs(REMOVED, plan.text_bucket(later.doc, later.version), False)

    for spans in spans_of(batches, bits):
        held.append(spans)
        if sum(map(len, held)) > LOT:
            yield from out()
    if held:
        yield from out()


def spans_of(batches: Iterator[pa.RecordBatch], bits: np.ndarray | None = None) -> Iterator[Spans]:
    for block in read(batches):
        with np.errstate(over="ignore"):
            one, two, bounds = block.named()
            p = parsed(one, two, bounds)
            doc, version, place = (np.array(x, np.int64) for x in (block.docs, block.versions, block.places))

            def spans(k: np.ndarray, f: np.ndarray, at: np.ndarray, size: np.ndarray) -> Spans:
                piece = np.searchsorted(bounds, at, "right") - 1
                return Spans(k, f, doc[piece], version[piece], at - bounds[piece] + place[piece], size)

            if bits is None:
                yield spans(p.k, p.f, p.first, p.last - p.first)
                continue
            hit = np.flatnonzero(in_filter(p.k, bits))
            # Of equal units of this block the earliest has the same windows earlier: the others are removed already.
            units = spans(p.k[hit], p.f[hit], p.first[hit], np.zeros(len(hit), np.int64))
            order = np.lexsort((units.at, units.version, units.doc, units.f, units.k))
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(units.k[order]) != 0) | (np.diff(units.f[order]) != 0)
            hit = np.sort(hit[order[new]])
            many = p.last[hit] - p.first[hit] + 1
            ends = np.cumsum(many)
            at = np.repeat(p.first[hit] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)
            yield spans(*p.window_names(at), at, np.zeros(len(at), np.int64))


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each bucket; rows come in order of it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def met(rows: DataFrame, plan: Plan, names: bool) -> DataFrame:
    """What is removed because an earlier one has its name, and, for units, pages of the bitmap of border names whose
    units differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, count = (np.zeros(FILTER_BITS // 8, np.uint8) if names else None), 0
        for held in by_bucket(batches):
            with np.errstate(over="ignore"):
                firsts, later, shared = Spans.unpacked(held).settled()
                yield from later.blobs(REMOVED, plan.text_bucket(later.doc, later.version), False)
                if names:
                    k = np.unique(np.concatenate([firsts.k[shared], firsts.k[listed(firsts.k, plan.frequent)]]))
                    at = mix(k + U(2)) & U(FILTER_BITS - 1)
                    np.bitwise_or.at(bits, (at >> U(3)).astype(np.int64), np.uint8(1) << (at & U(7)).astype(np.uint8))
                    count += len(k)
        if count:
            pages = bits.reshape(-1, PAGE // 8)
            used = np.flatnonzero(pages.any(1)).tolist()
            step = 256
            for i in range(0, len(used), step):
                yield records([(NAMES, p, count if p == used[0] else 0, zstandard.compress(pages[p].tobytes(), 1), *[None] * 5) for p in used[i : i + step]])

    return rows.where(F.col("kind") == UNITS).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, RECORD)


def filter_of(pages: DataFrame) -> np.ndarray:
    """The bitmap, folded to ``BITS_EACH`` bits a name: 32 MB at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in by_bucket(batches):
            page = np.bitwise_or.reduce([np.frombuffer(zstandard.decompress(r["k"]), np.uint8) for r in held])
            yield records([(NAMES, held[0]["bucket"], sum(r["n"] for r in held), page.tobytes(), *[None] * 5)])

    merged = pages.where(F.col("kind") == NAMES).select(*COLUMNS).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, RECORD)
    bits, count = np.zeros(FILTER_BITS // 8, np.uint8), 0
    for row in merged.select("bucket", "n", "k").toLocalIterator():
        bits[row["bucket"] * PAGE // 8 : (row["bucket"] + 1) * PAGE // 8] = np.frombuffer(row["k"], np.uint8)
        count += row["n"]
    size = 1 << 20
    while size < min(count * BITS_EACH, FILTER_BITS):
        size *= 2
    return np.bitwise_or.reduce(bits.reshape(-1, size // 8), 0)


def frequent_names(docs: DataFrame, count: int) -> np.ndarray:
    """Border names that many sampled documents have with different words. They only decide how units are dealt."""
    few = docs.sample(min(1.0, SAMPLED / max(count, 1)), seed=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for spans in spans_of(batches):
            pairs = np.unique(np.stack([spans.k, spans.f]), axis=1)
            k, times = np.unique(pairs[0], return_counts=True)
            often = times > 1
            yield pa.RecordBatch.from_arrays([pa.array(k[often].view(np.int64)), pa.array(times[often])], names=["k", "n"])

    least = max(2, int(FREQUENT * min(SAMPLED, count)))
    found = few.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    top = found.orderBy(F.desc("n"), "k").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["k"] for r in top], np.int64).view(U))


# -- over Spark -------------------------------------------------------------------------------------------------------


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept_sha256`` of each row, with ``kept`` (the words that stay, joined
    by spaces) if asked for."""
    spark = df.sparkSession
    scratch = Scratch(spark, "substrings")
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    by_id = df.groupBy(id_col).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes"))
    facts = by_id.agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.col(id_col).isNull()).alias("null")).first()
    # Where ids tell rows apart they need no second part.
    version = F.xxhash64(text) if (facts["most"] or 0) > 1 or facts["null"] else F.lit(0).cast("long")
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), version.alias("version"), text.alias("text"))
    parts = int(facts["bytes"] or 0) // BUCKET_BYTES + int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = Plan(parts, prime(parts), frequent_names(docs, facts["n"] or 0))

    units = scratch.put(docs.mapInArrow(lambda batches: gathered(batches, plan, None), RECORD), "units")
    over = scratch.put(met(units, plan, True), "over")
    bits = spark.sparkContext.broadcast(filter_of(over))
    windows = scratch.put(docs.mapInArrow(lambda batches: gathered(batches, plan, bits.value), RECORD), "windows")
    by_window = Plan(plan.units, plan.texts, np.zeros(0, U))
    again = scratch.put(met(windows, by_window, False), "again")

    removed = units.unionByName(over).unionByName(windows).unionByName(again).where(F.col("kind") == REMOVED)
    spans = scratch.put(removed.repartition("bucket"), "removed")
    scratch.drop_all_but(spans)

    bucket = F.pmod(F.pmod("doc", F.lit(plan.texts)) + F.pmod("version", F.lit(plan.texts)), F.lit(plan.texts)).cast("int")
    texts = docs.select(bucket.alias("bucket"), F.lit(1).alias("role"), "doc", "version", "text")
    rows = spans.withColumn("role", F.lit(0)).unionByName(texts, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, table = None, [], None
        for batch in batches:
            out = []
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if row["bucket"] != bucket:
                    bucket, held, table = row["bucket"], [], None
                if row["role"] == 0:
                    held.append(row)
                    continue
                if table is None:
                    table = Removal(Spans.unpacked(held)) if held else Removal(None)
                    held = []
                out.append((None if row["doc"] == NULL_ID else row["doc"], *table.kept(row["doc"], row["version"], row["text"], with_text)))
                if with_text and sum(len(o[-1]) for o in out) > PIECE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    names = [id_col, "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else [])]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.string()] if with_text else [])]
    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return rows.mapInArrow(run, schema)


class Removal:
    """Removed spans of the documents of a bucket."""

    def __init__(self, spans: Spans | None):
        self.spans = spans
        self.of: dict[tuple[int, int], tuple[int, int]] = {}
        if spans is not None:
            x = self.spans = spans[np.lexsort((spans.at, spans.version, spans.doc))]
            edges = np.concatenate([[0], np.flatnonzero((np.diff(x.doc) != 0) | (np.diff(x.version) != 0)) + 1, [len(x)]]).tolist()
            self.of = {(d, v): (i, j) for d, v, i, j in zip(x.doc[edges[:-1]].tolist(), x.version[edges[:-1]].tolist(), edges[:-1], edges[1:])}

    def kept(self, doc: int, version: int, text: bytes, with_text: bool) -> tuple:
        """Numbers of words and of removed ones, digest of the kept ones, and these, joined."""
        digest, kept, n, gone = hashlib.sha256(), [], 0, 0
        i, j = self.of.get((doc, version), (0, 0))
        at, size = (self.spans.at[i:j], self.spans.size[i:j]) if j > i else (None, None)
        any_kept = False
        for part in [text] if len(text) <= PIECE_BYTES else pieces(text):
            stay = words = part.split()
            if at is not None:
                cover = np.zeros(len(words) + 1, np.int64)
                begin, end = np.clip(at - n, 0, len(words)), np.clip(at - n + size + WINDOW, 0, len(words))
                np.add.at(cover, begin, 1)
                np.add.at(cover, end, -1)
                keep = np.cumsum(cover[:-1]) == 0
                stay = [w for w, k in zip(words, keep.tolist()) if k]
            n, gone = n + len(words), gone + len(words) - len(stay)
            if stay:
                joint = (b" " if any_kept else b"") + b" ".join(stay)
                any_kept = True
                digest.update(joint)
                if with_text:
                    kept.append(joint)
        return (n, gone, digest.hexdigest(), *([b"".join(kept).decode()] if with_text else []))
