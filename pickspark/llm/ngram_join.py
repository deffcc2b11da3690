"""N-gram Jaccard join: which documents' word-shingle sets are similar, and the groups they form.

Exact at every size, without comparing all documents of a size:

1. *Size bands.* Sizes are cut into bands such that similar sets lie in the same or in neighbouring bands. Each
   set is dealt, for its own band and for the next, into hash ranges, more of them than similar sets of that band
   can differ in shingles. A set that may differ from its partners in ``d`` shingles sends the ranges of most
   shingles, at least ``d + 1`` of them (all as long as the last one): a differing shingle spoils one range, so
   similar sets agree wholly in a range that both send. A *tile* is the sets of a band that agree in one range.
   Short sets that have no ``d + 1`` ranges with a shingle send their smallest hashes besides (two similar sets share
   one among so many).
2. *Bitmap signatures.* Every set carries a hashed parity bitmap, longer for larger sets. Two sets differ in at
   least as many shingles as their bitmaps in bits, which bounds their overlap from above.
3. *Exact check* of what the bound lets pass, by intersection of sorted arrays.

First each set is compared with the set it shares most tiles with (of the first of each tile); the links so found give
components. Then tiles whose members are in several components are compared across them, bitmaps only, in pairs of
blocks of ``BLOCK`` members, each pair its own group for the shuffle, so that no tile is held whole. Of each member and
other component the best candidate is checked, then the best sixteen of what is still apart, then all: no
similar pair is lost, and pairs inside a component are not made. Equal sets are one node from the start, so
copies cost nothing. Texts are sent once for each candidate, next to the one they are compared with.

Edge cases: a null or empty text, or one without words, has an empty set and is linked with nothing (its
component is its own id); a text with fewer words than a shingle has its whole sequence as its one
shingle; repeated rows are copies of each other; ids are taken to be unique, rows that share one may share
a component; rows without an id have no component; very long texts are hashed in pieces; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, chunks, lean
from .components import connected_components
from .hashing import IS_SPACE, PAD, U, mix, word_names

#: Rows of a counted table that are sent to every executor instead of shuffling texts (tens of bytes each).
MOST_SENT = 250_000
#: Members of a tile, and candidates of one set, that are compared at a time.
BLOCK = 512
#: Bits of a bitmap: the next power of two over the set's size within these bounds.
BITS = 512, 1 << 17
#: Bytes hashed at a time.
SLAB = 1 << 21
#: Hash ranges for each shingle that sets of a band may differ in.
RANGES = 1.15


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each stretch without white space, a slab at a time; slabs end at white space."""
    hashes, begins, at = [], [], 0
    while at < len(data):
        end = min(at + SLAB, len(data))
        while end < len(data) and not IS_SPACE[data[end]]:
            space = np.flatnonzero(IS_SPACE[data[end : end + SLAB]])
            end = end + int(space[0]) if len(space) else min(end + SLAB, len(data))
        begin, (h,) = word_names(np.concatenate([data[at:end], np.frombuffer(PAD, np.uint8)]))
        hashes.append(h)
        begins.append(begin + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(begins)) if hashes else (np.zeros(0, U), np.zeros(0, np.int64))


def shingled(w: np.ndarray, words: int) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a sequence of word hashes."""
    if len(w) >= words:
        h = np.zeros(len(w) - words + 1, U)
        for i in range(words):
            h = mix(h + w[i : len(w) - words + 1 + i])
        return np.unique(h)
    h = np.full(min(1, len(w)), len(w), U)  # fewer words than a shingle
    for i in range(len(w)):
        h = mix(h + w[i : i + 1])
    return h


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; A-Z are lower-cased, words are stretches
    without white space (space, tab, line feed, vertical tab, form feed, carriage return)."""
    raw = [(t or b"").lower() for t in texts]  # bytes: A-Z only
    with np.errstate(over="ignore"):
        if sum(map(len, raw)) + len(raw) > SLAB:
            return [shingled(word_hashes(np.frombuffer(r, np.uint8))[0], words) for r in raw]
        hashes, begins = word_hashes(np.frombuffer(b"\n".join([*raw, b""]), np.uint8))
        stops = np.searchsorted(begins, np.cumsum([len(r) + 1 for r in raw]))
        return [shingled(w, words) for w in np.split(hashes, stops[:-1])]


class Bands:
    """Size bands for Jaccard similarity of ``num / den`` at least."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.first = num, den, [1]

    def border(self, band: int) -> int:
        """The smallest size of a band."""
        while len(self.first) <= band:
            self.first.append(self.first[-1] * self.den // self.num + 1)
        return self.first[band]

    def of(self, n: int) -> int:
        while self.first[-1] <= n:
            self.border(len(self.first))
        return bisect.bisect_right(self.first, n) - 1

    def differ(self, n: int, band: int) -> int:
        """In how many shingles a set of ``n`` may differ from a similar one of the band or, in its own, a smaller one."""
        most = min(self.border(band + 1) - 1, n * self.den // self.num)
        return (self.den - self.num) * (n + most) // (self.den + self.num)

    def ranges(self, band: int) -> int:
        largest = self.border(band + 1) - 1
        return int(RANGES * ((self.den - self.num) * 2 * largest // (self.den + self.num))) + 1


def tile_keys(h: np.ndarray, bands: Bands) -> np.ndarray:
    """The tiles of a set that is not empty: range sums for its band and, where it may have partners, the next."""
    n, own = len(h), bands.of(len(h))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h ^ U(0x5851F42D4C957F2D)))])
    out, short = [], False
    for band in (own, own + 1) if n * bands.den // bands.num >= bands.border(own + 1) else (own,):
        k, need = bands.ranges(band), bands.differ(n, band) + 1
        at = np.searchsorted(h, np.arange(1, k, dtype=U) * U((1 << 64) // k)) if k > 1 else np.zeros(0, np.int64)
        at = np.concatenate([[0], at, [n]])
        size = np.diff(at)
        least = int(np.partition(size, k - need)[k - need]) if need <= k else 0
        short |= least == 0
        part = sums[at[1:]] - sums[at[:-1]]
        key = mix(part + mix(np.arange(k, dtype=U) + U(band << 32)) + size.astype(U))
        out.append(key[size >= max(least, 1)])
    if short:
        out.append(mix(h[: n + bands.num * -n // bands.den + 1] ^ U(0xA0761D6478BD642F)))
    return np.concatenate(out)


def bitmap(h: np.ndarray) -> bytes:
    """The set's size (8 bytes), then bit i: whether it has an odd number of shingles that hash to i."""
    bits = min(max(BITS[0], 1 << max(0, len(h) - 1).bit_length()), BITS[1])
    odd = np.bincount((h & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return len(h).to_bytes(8, "little") + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(marks: list[bytes], least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sizes, and bitmaps of equal length as rows of 64-bit words: the halves of longer ones are added."""
    n = np.array([int.from_bytes(m[:8], "little") for m in marks], np.int64)
    width = least or min((len(m) - 8) // 8 for m in marks)
    return n, np.stack([np.bitwise_xor.reduce(np.frombuffer(m, "<u8", offset=8).reshape(-1, width), 0) for m in marks])


def keyed(df: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``node`` (the document's id) and ``key``: a row for each of its tiles. The shingles are hashed anew, which
    costs less than keeping the keys of all documents on disk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                with np.errstate(over="ignore"):
                    keys = [tile_keys(h, bands).view(np.int64) if len(h) else np.zeros(0, np.int64) for h in shingle_sets(part.column("text").to_pylist(), words)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("doc_id").to_numpy(), [len(k) for k in keys])), pa.array(np.concatenate(keys))], names=["node", "key"])

    return df.where("doc_id IS NOT NULL").mapInArrow(lean(run), "node long, key long")


def described(df: DataFrame, words: int) -> DataFrame:
    """One row for each document: size, fingerprint and bitmap of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                with np.errstate(over="ignore"):
                    sets = shingle_sets(part.column("text").to_pylist(), words)
                    prints = np.array([(mix(h).sum(dtype=U), mix(h ^ U(0x2545F4914F6CDD1D)).sum(dtype=U)) for h in sets], U).view(np.int64)
                columns = [part.column("doc_id").cast(pa.int64()), pa.array([len(h) for h in sets], pa.int64()), *(pa.array(prints[:, i]) for i in range(2)), pa.array([bitmap(h) for h in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "fa", "fb", "bits"])

    return df.mapInArrow(lean(run), "doc_id long, n long, fa long, fb long, bits binary")


def only(df: DataFrame, ids: DataFrame, column: str = "doc_id", how: str = "left_semi", most: int = MOST_SENT) -> DataFrame:
    """``df`` joined with the written table ``ids``, which is sent to all executors only if it was counted and has
    ``most`` rows at most; else both sides are shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, column, how)


#: Whether each of some payloads goes with that of the set they are compared with.
Test = Callable[[object, list], np.ndarray]


def compared(scratch: Scratch, pairs: DataFrame, payloads: DataFrame, prepare: Callable[[list[bytes]], list], test: Test) -> DataFrame:
    """The pairs (a, b; written) that pass ``test``. ``payloads``: id and payload (binary). The b of an a are sent to
    it in blocks, each payload once for each of its pairs; a task holds one payload of an a and a batch of others."""
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    many = pairs.groupBy("a").agg(F.count("*").alias("_n"))
    members = pairs.join(many, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), blocks).cast("int").alias("block"), F.lit(1).alias("role"))
    centres = many.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(0).alias("role"))
    asked = scratch.put(members.unionByName(centres), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, None
        for batch in batches:
            for part in chunks(batch, "payload", 1 << 20):
                own = prepare(part.column("payload").to_pylist())
                a, block, role = (part.column(n).to_pylist() for n in ("a", "block", "role"))
                good, i = np.zeros(len(own), bool), 0
                while i < len(own):
                    if role[i] == 0:
                        at, centre = (a[i], block[i]), own[i]
                        i += 1
                        continue
                    j = i
                    while j < len(own) and role[j] and (a[j], block[j]) == (a[i], block[i]):
                        j += 1
                    if at == (a[i], block[i]):
                        good[i:j] = test(centre, own[i:j])
                    i = j
                yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(good)), part.column("id").filter(pa.array(good))], names=["a", "b"])

    sent = only(payloads, asked, "id", "inner")
    dealt = sent.repartition("a", "block").sortWithinPartitions("a", "block", "role", "id")
    return scratch.put(dealt.select("a", "block", "role", "id", "payload").mapInArrow(lean(run), "a long, b long").distinct(), "passed")


def by_bitmap(num: int, den: int) -> Test:
    def test(centre: bytes, others: list[bytes]) -> np.ndarray:
        n, bits = folded([centre, *others])
        most = (n[0] + n[1:] - np.bitwise_count(bits[1:] ^ bits[0]).sum(1, dtype=np.int64)) // 2
        return den * most >= num * (n[0] + n[1:] - most)

    return test


def by_intersection(num: int, den: int) -> Test:
    def test(centre: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        same = np.array([len(np.intersect1d(centre, x, assume_unique=True)) for x in others], np.int64)
        total = np.array([len(centre) + len(x) for x in others], np.int64)
        return den * same >= num * (total - same)

    return test


def open_tiles(tiles: DataFrame, found: DataFrame) -> DataFrame:
    """Members (key, node, component, blocks) of tiles with several components; of tiles with the same members one."""
    placed = only(tiles.select("key", "node"), found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    seen = placed.groupBy("key").agg(F.count("*").alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("_who"))
    apart = seen.where("_n > 1 AND _low < _high").groupBy("_n", "_who", "_low", "_high").agg(F.min("key").alias("key"))
    return placed.join(apart.select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")), "key")


def candidates(members: DataFrame, marks: DataFrame, num: int, den: int, limit: int | None) -> DataFrame:
    """Pairs of one tile that are in different components and may link: of each set and other component the
    ``limit`` best, in each pair of blocks. ``members``: key, node, component, blocks (written); ``marks``: node, bits."""

    def best(x: dict, y: dict) -> Iterator[pa.RecordBatch]:
        width = x["bits"].shape[1]
        step = max(1, (1 << 21) // (width * len(y["node"])))
        for i in range(0, len(x["node"]), step):
            part = {k: v[i : i + step] for k, v in x.items()}
            apart = np.bitwise_count(part["bits"][:, None, :] ^ y["bits"][None, :, :]).sum(2, dtype=np.int64)
            total = part["n"][:, None] + y["n"][None, :]
            most = (total - apart) // 2
            at, to = np.nonzero((den * most >= num * (total - most)) & (part["component"][:, None] != y["component"][None, :]))
            if limit is not None and len(at):
                order = np.lexsort((y["node"][to], -most[at, to] / total[at, to], y["component"][to], at))
                at, to = at[order], to[order]
                new = np.concatenate([[True], (at[1:] != at[:-1]) | (y["component"][to[1:]] != y["component"][to[:-1]])])
                rank = np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                at, to = at[rank < limit], to[rank < limit]
            if len(at):
                a, b = part["node"][at], y["node"][to]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    names = ["key", "i", "j", "block", "node", "component", "bits"]

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, i, j, block, node, component, bits = zip(*rows)
        n, maps = folded(list(bits))
        whole = {"node": np.array(node), "component": np.array(component), "n": n, "bits": maps}
        first = np.array(block) == i[0]
        if (whole["component"] == whole["component"][0]).all() or i[0] != j[0] and first.all():
            return
        yield from best({k: v[first] for k, v in whole.items()}, {k: v[first if i[0] == j[0] else ~first] for k, v in whole.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if held and row[:3] != held[0][:3]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("block", own).withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rows = dealt.select(*names[:-1]).join(marks, "node").select(*names)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "block", "node").mapInArrow(lean(run), "a long, b long").distinct()


def similarity_components(df: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row. Two rows link if
    ``den * |intersection| >= num * |union|`` of their shingle sets."""
    scratch = Scratch(df.sparkSession, "ngram-join")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = scratch.put(described(docs, words), "sets")
    members = rows.select("doc_id", "n", "fa", "fb")
    marks = rows.select(F.col("doc_id").alias("node"), "bits")
    nodes = scratch.put(members.where("n > 0").groupBy("fa", "fb").agg(F.min("doc_id").alias("node")), "nodes")
    copies = scratch.put(members.join(nodes, ["fa", "fb"]).where("doc_id <> node").select("doc_id").distinct(), "copies")
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("payload"))

    def checked(pairs: DataFrame) -> DataFrame:
        return compared(scratch, pairs, texts, lambda part: shingle_sets(part, words), by_intersection(num, den))

    # Tiles of one member end here.
    by = Window.partitionBy("key").orderBy("node")
    inside = keyed(only(docs, copies, how="left_anti"), words, num, den).withColumns({"first": F.first("node").over(by), "before": F.lag("node").over(by), "after": F.lead("node").over(by)})
    tiles = scratch.put(inside.where("before IS NOT NULL OR after IS NOT NULL").select("key", "node", "first"), "tiles")

    # Round 1: each set with the first of most of its tiles.
    shared = tiles.where("node <> first").groupBy("node", "first").agg(F.count("*").alias("_n"))
    stars = scratch.put(shared.groupBy("node").agg(F.max_by("first", F.struct(F.col("_n"), -F.col("first"))).alias("a")).select("a", F.col("node").alias("b")), "stars")
    near = compared(scratch, stars, marks.toDF("id", "payload"), list, by_bitmap(num, den))
    links = checked(near)
    found, tried = connected_components(links), stars

    # Round 2: across the components that tiles still have.
    for limit in (1, 16, None):
        left = scratch.put(open_tiles(tiles, found), "open")
        pairs = scratch.put(candidates(left, only(marks, scratch.put(left.select("node").distinct(), "ids"), "node"), num, den, limit), "pairs")
        if not pairs.limit(1).count():
            break
        new = scratch.put(pairs.join(tried, ["a", "b"], "left_anti"), "new")
        tried = tried.unionByName(new)
        more = checked(new)
        if more.limit(1).count():
            links = links.unionByName(more)
            found = connected_components(links)

    scratch.drop_all_but(rows, nodes)
    of_print = nodes.join(found, "node", "left").select("fa", "fb", F.coalesce("component", "node").alias("_component"))
    return members.join(of_print, ["fa", "fb"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(df: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` without near duplicates: the smallest id of each component stays. Of repeated rows with
    that id one stays, the first in order of all their columns as text; rows without an id stay."""
    scratch = Scratch(df.sparkSession, "one-of-each")
    found = similarity_components(df, words, num, den, id_col, text_col).where("doc_id = component_id")
    keep = scratch.put(found.groupBy(F.col("doc_id").alias(id_col)).agg(F.count("*").alias("_rows")), "keep")
    once = only(df, scratch.put(keep.where("_rows = 1").select(id_col), "once"), id_col)
    out = once.unionByName(df.where(F.col(id_col).isNull()))
    if keep.where("_rows > 1").limit(1).count():
        again = df.join(keep.where("_rows > 1").select(id_col), id_col, "left_semi").withColumn("_order", F.to_json(F.struct(*df.columns)))
        first = F.row_number().over(Window.partitionBy(id_col).orderBy("_order"))
        out = out.unionByName(again.withColumn("_order", first).where("_order = 1").drop("_order").select(df.columns))
    return out
