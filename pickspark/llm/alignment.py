"""Alignment of two tokenizers' tokens of the same text, and how often their ids are linked.

Tokens of A (byte-level BPE of space + text) and B (pieces of the text, before which B puts a space) are laid over the
same bytes. Where tokens of both end, the text is cut; what lies between two cuts is a group. Cuts are found by
dividing: in an interval that ends at a cut, a common end near the middle is looked for, each A end by bisection in
the B ends; the interval is divided there and both halves are treated alike; an interval without a common end
inside is a leaf, and so a group. All intervals of a block are divided in step.

A space between two characters that are none begins a token of both (what that rests on is checked when the models
are loaded), so each *stretch* from one such space to the next is an interval of its own, and is tokenized and divided
once for each time a worker meets it anew. A document's outcome is put together from those of its stretches. Each block
of documents keeps its distinct stretches, their links, and how often each document has them; links are counted over
all blocks by Spark, joined back to the blocks' distinct pairs, and summed by document. No table of pairs is collected
or sent out.

Edge cases: a null or empty text, and one whose tokens' bytes differ from space + text (one with U+2581, which B takes
for a space), has no tokens: zeros and an empty digest; its pairs count nowhere; texts of any length are aligned whole,
one stretch being the least that is held; repeated rows and ids stay separate rows and count each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import chunks, written
from .grammar_files import LibraryEncoder
from .token_counts import MARK, model

#: A space between characters that are none.
CUT = re.compile(rf"(?<=[^ {MARK}]) (?=[^\s{MARK}])")
ODD = re.compile(rf"^ |  | $|{MARK}| (?=\s)")
#: Stretches whose outcome a worker remembers; longer ones than LONG are not kept from block to block.
MEMO, LONG = 400_000, 100
#: Bytes of text in a block, and of it that are cut into stretches at a time.
BLOCK_BYTES, STEP_BYTES = 24 << 20, 2 << 20


def shared_ends(a_end: np.ndarray, b_end: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which tokens of A end where a token of B does. The intervals of A tokens ``first..last`` each end at one."""
    shared = np.zeros(len(a_end), bool)
    shared[last] = True
    lo, hi = first, last  # an interval's inner ends are those of its tokens lo..hi-1
    while True:
        inner = hi > lo
        lo, hi = lo[inner], hi[inner]
        if not len(lo):
            return shared
        middle, at = (lo + hi) // 2, np.full(len(lo), -1, np.int64)
        waiting, far = np.arange(len(lo)), 0
        while len(waiting):  # further and further from the middle
            for token in {0: (middle[waiting],)}.get(far, (middle[waiting] + far, middle[waiting] - far)):
                inside = (token >= lo[waiting]) & (token < hi[waiting]) & (at[waiting] < 0)
                own, token = waiting[inside], token[inside]
                same = b_end[np.searchsorted(b_end, a_end[token])] == a_end[token]
                at[own[same]] = token[same]
            far += 1
            waiting = waiting[(at[waiting] < 0) & ((middle[waiting] + far < hi[waiting]) | (middle[waiting] - far >= lo[waiting]))]
        divided = at >= 0
        cut = at[divided]
        shared[cut] = True
        lo, hi = np.concatenate([lo[divided], cut + 1]), np.concatenate([cut, hi[divided]])


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The A and the B token of each overlapping pair: one for each stretch between neighbouring ends of either."""
    ends = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


def stretches(text: str) -> list[str]:
    """What follows the spaces (one is put before the text) at which both tokenizers begin a token."""
    return CUT.split(text) if ODD.search(text) else text.split(" ")


class Numbers(dict):
    def __missing__(self, stretch: str) -> int:
        self[stretch] = at = len(self)
        return at


class Aligner:
    """Outcomes of stretches, remembered by number."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = LibraryEncoder(a_path), model(b_path)
        of = byte_letters()
        self.a_bytes = {i: bytes(of[c] for c in s) for s, i in self.a.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in of for c in s)}
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, s in self.a_bytes.items():
            self.a_size[i] = len(s)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array([len(p) for p in self.b_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        self.number, self.known = Numbers(), 0
        self.groups: list[bytes] = []
        self.facts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, whether the bytes agree
        self.pair_ends, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.asked = np.zeros(0, np.int64)

    def forget(self) -> None:
        """When the table is full, what was asked for once goes, as do long stretches."""
        if len(self.number) < MEMO:
            return
        old, stay = self.number, np.flatnonzero(self.asked > 1)
        groups, facts, ends, pairs, names = self.groups, self.facts, self.pair_ends, self.pairs, list(old)
        stay = stay[[len(names[i]) <= LONG for i in stay.tolist()]] if len(stay) < MEMO // 2 else stay[:0]
        self.clear()
        self.number.update((names[i], n) for n, i in enumerate(stay.tolist()))
        self.groups, self.facts, self.known, self.asked = [groups[i] for i in stay.tolist()], facts[stay], len(stay), np.zeros(len(stay), np.int64)
        sizes = np.diff(ends)[stay]
        self.pair_ends = np.concatenate([[0], np.cumsum(sizes)])
        self.pairs = pairs[np.repeat(ends[:-1][stay] - self.pair_ends[:-1], sizes) + np.arange(self.pair_ends[-1])]

    def numbers(self, parts: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        if len(self.number) > self.known:
            new = [p for p, _ in zip(reversed(self.number), range(len(self.number) - self.known))][::-1]
            self.align(new)
        return at

    def align(self, parts: list[str]) -> None:
        """Outcomes of new stretches, each after a space."""
        a_ids, a_many = self.a.ask_all(parts, [False] * len(parts))
        b_lists = self.b.encode(parts, num_threads=1)
        b_many = np.array([len(x) for x in b_lists], np.int64)
        want = [(" " + p).encode() for p in parts]
        sizes = np.array([len(w) for w in want], np.int64)
        good = np.array([b"".join([self.b_bytes[i] for i in x]) == w for x, w in zip(b_lists, want)], bool)
        own_a = np.repeat(np.arange(len(parts)), a_many)
        good &= np.bincount(own_a, self.a_size[a_ids], len(parts)).astype(np.int64) == sizes
        # Only stretches whose bytes agree are laid side by side.
        a_ids = a_ids[good[own_a]].astype(np.int64)
        b_ids = np.array([i for x, g in zip(b_lists, good.tolist()) if g for i in x], np.int64)
        a_many, b_many = np.where(good, a_many, 0), np.where(good, b_many, 0)
        a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        stop_a, stop_b = np.cumsum(a_many), np.cumsum(b_many)
        some = a_many > 0
        shared = shared_ends(a_end, b_end, (stop_a - a_many)[some], stop_a[some] - 1)
        of_a, of_b = links(a_end, b_end)
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        # Group borders: tokens of A and of B that end one.
        cut_a = np.flatnonzero(shared)
        cut_b = np.searchsorted(b_end, a_end[cut_a])
        made, i, j = [], 0, 0
        for x, y in zip((cut_a + 1).tolist(), (cut_b + 1).tolist()):
            made.append((a_text[i] if x == i + 1 else ",".join(a_text[i:x])) + "|" + (b_text[j] if y == j + 1 else ",".join(b_text[j:y])))
            i, j = x, y
        group_stop = np.searchsorted(cut_a, stop_a, "left")
        group_many = np.diff(group_stop, prepend=0)
        i = 0
        for x in group_stop.tolist():
            self.groups.append((made[i] if x == i + 1 else ";".join(made[i:x])).encode())
            i = x
        pair_many = np.bincount(np.searchsorted(stop_a, of_a, "right"), minlength=len(parts))
        self.facts = np.concatenate([self.facts, np.stack([a_many, b_many, group_many, good.astype(np.int64)], 1)])
        self.pairs = np.concatenate([self.pairs, (a_ids[of_a] << 32) | b_ids[of_b]])
        self.pair_ends = np.concatenate([self.pair_ends, self.pair_ends[-1] + np.cumsum(pair_many)])
        self.asked = np.concatenate([self.asked, np.zeros(len(parts), np.int64)])
        self.known = len(self.number)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker."""
    key = a_path, b_path
    if key not in _aligners:
        _aligners[key] = Aligner(a_path, b_path)
    return _aligners[key]


def packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(x, prepend=0).astype(np.int32).tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int32), dtype=np.int64)


BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "pairs array<long>, counts array<long>, doc_ends binary, places binary, times binary, link_ends binary, link_pairs binary"
)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the ranges with these starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def aligned_block(x: Aligner, rows: Iterator[tuple[list, list[str | None]]]) -> pa.RecordBatch:
    """One block: ids and texts come a step at a time."""
    ids, facts, digests, numbers, times, doc_ends = [], [], [], [], [], [0]
    for own_ids, texts in rows:
        ids += own_ids
        parts = [stretches(t) if t else [] for t in texts]
        stops = np.cumsum([len(p) for p in parts])
        at = x.numbers([u for p in parts for u in p])
        x.asked += np.bincount(at, minlength=len(x.asked))
        for i, j in zip([0, *stops[:-1].tolist()], stops.tolist()):
            own = at[i:j]
            fact = x.facts[own]
            if j == i or not fact[:, 3].all():
                facts.append((0, 0, 0))
                digests.append("")
                own = own[:0]
            else:
                facts.append(tuple(fact[:, :3].sum(0).tolist()))
                digests.append(hashlib.sha256(b";".join([x.groups[k] for k in own.tolist()])).hexdigest())
            u, n = np.unique(own, return_counts=True)
            numbers.append(u)
            times.append(n)
            doc_ends.append(doc_ends[-1] + len(u))
    number, many = np.concatenate([*numbers, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)])
    distinct, place = np.unique(number, return_inverse=True)
    freq = np.bincount(place, many, len(distinct)).astype(np.int64)
    sizes = np.diff(x.pair_ends)[distinct]
    pair, link = np.unique(x.pairs[spread(x.pair_ends[distinct], sizes)], return_inverse=True)
    counts = np.bincount(link, np.repeat(freq, sizes), len(pair)).astype(np.int64)
    fact = np.array(facts, np.int64).reshape(-1, 3)
    longs = lambda v: pa.array([v], pa.list_(pa.int64()))
    arrays = [pa.array([uuid.uuid4().int >> 65]), longs(ids), *(longs(fact[:, i]) for i in range(3)), pa.array([digests], pa.list_(pa.string())), longs(pair), longs(counts)]
    arrays += [pa.array([packed(v)], pa.binary()) for v in (np.array(doc_ends), place, many, np.concatenate([[0], np.cumsum(sizes)]), link)]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BLOCK.split(", ")])


def blocks(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = aligner(a_path, b_path)
        for batch in batches:
            for block in chunks(batch, "text", BLOCK_BYTES):
                x.forget()
                yield aligned_block(x, ((s.column("id").to_pylist(), s.column("text").to_pylist()) for s in chunks(block, "text", STEP_BYTES)))

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCK)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair`` (A id, and B id in the low 32 bits), ``n`` over all blocks, and whether no A id has more with the B id."""
    n = found.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    n = written(n.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    return n.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each row."""
    found = written(blocks(df, a_path, b_path, id_col, text_col), "aligned")
    listed = found.select("block", F.posexplode("pairs").alias("place", "pair"))
    valued = listed.join(pair_counts(found.select("pairs", "counts")), "pair")
    by_block = valued.groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                values = row.column("values").flatten()
                n, best = np.zeros((2, len(values)), np.int64)
                if len(values):
                    place = values.field("place").to_numpy()
                    n[place], best[place] = values.field("n").to_numpy(), values.field("best").to_numpy(zero_copy_only=False)
                doc_ends, places, times, link_ends, link = (unpacked(row.column(c)[0].as_py()) for c in ("doc_ends", "places", "times", "link_ends", "link_pairs"))
                sums = []
                for value in (np.ones(len(values), np.int64), best, n):
                    by_stretch = np.diff(np.concatenate([[0], np.cumsum(value[link])])[link_ends])
                    running = np.concatenate([[0], np.cumsum(by_stretch[places] * times)])
                    sums.append(pa.array(np.diff(running[doc_ends]), pa.int64()))
                flat = [row.column(c).flatten() for c in ("doc_ids", "n_a", "n_b", "n_groups", "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*flat[:4], *sums, flat[4]], names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    # Blocks of documents without tokens have no pairs, hence the outer join.
    joined = found.drop("pairs", "counts").join(by_block, "block", "left")
    return joined.mapInArrow(run, f"`{id_col}` long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
