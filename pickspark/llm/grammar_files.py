"""Token ids in grammar-compressed files (Re-Pair).

Documents are range-partitioned by id; each task is a shard and writes its documents in order as blocks of
about ``BLOCK_TOKENS`` ids (whole documents). In a block, the most frequent pairs of neighbouring symbols are
replaced by new symbols, round after round, until no pair occurs ``LEAST`` times. A round takes the pairs that are at
least an eighth as frequent as the most frequent one is; where two of them overlap, the more frequent one wins.
The block keeps the rules, the expansion length of every new symbol, and the remaining sequence, so that any range of
ids can be read without expanding the rest. A file is a Parquet file with one row for each block.

Edge cases: a null or empty text gives the end id alone; equal document ids stay separate documents, in the
order of their texts; null ids come first; an empty table gives no blocks; a document longer than a block
is a block of its own; other columns are not read. Symbols have 16 bits where the vocabulary leaves room: a block that
has used up its 65,536 symbols keeps the rest of its sequence as it is.
"""

from __future__ import annotations

import gc
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import CUT, PATTERN, UNSAFE, byte_letters, pre_tokens
from .common import chunks, shared_dir, text_or_empty
from .hashing import PAD, names

BLOCK_TOKENS = 1 << 20
#: Stretches whose ids a worker remembers (some 30 bytes each), and pre-tokens of texts with runs of blanks.
MEMO, PIECES = 2_500_000, 50_000
#: Bytes of a stretch that is hashed.
LONGEST = 1 << 16
#: A pair is replaced while it occurs so often.
LEAST = 24
#: First bytes of blanks in UTF-8 (and of other letters).
MAY_BE_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3])
#: ASCII letters, and what of ASCII is neither letter nor space.
LETTER = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
OTHER = (np.arange(256) < 128) & ~LETTER & (np.arange(256) != 32)
#: Pairs are counted by hashes of so many bits.
SLOTS = 18
#: Letters of several scripts and kinds, on which the pattern must cut as the library does.
PROBE = "a\u0300 \u00df\u0130\u1e9e 1\u00b2\u2167\u4e00\u00bd x\u200d\u0903\u0e31 \u3000\u2028\x85\x1c\u2009-\u2014\u20ac\U0001f600\ua7dc\U00010d6f\u1c89 it's"

BLOCKS = "shard int, block int, start_in_shard long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, first_rule int, rules binary, lengths binary, symbols binary"


def spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` with these starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return flat[:0]
    kind = np.int32 if max(ends[-1], len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((starts - ends + sizes).astype(kind), sizes) + np.arange(ends[-1], dtype=kind)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin inside a stretch whatever is around: behind an ASCII letter what is none, and behind a single
    line break what is no blank. So words are the same stretch with and without the punctuation that follows."""
    line = np.flatnonzero(data[1:-1] == 10) + 1
    line = line[(data[line - 1] > 32) & (data[line - 1] < 127) & ~MAY_BE_BLANK[data[line + 1]]]
    return np.sort(np.concatenate([np.flatnonzero(LETTER[data[:-1]] & OTHER[data[1:]]), line]), kind="stable") + 1


class Memo:
    """Ids of stretches by name, in sorted arrays, with a second name that is compared when a stretch is found. When it
    is full, what was not asked for again goes."""

    def __init__(self) -> None:
        self.keys, self.starts, self.sizes, self.asked = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        self.checks = np.zeros(0, np.uint64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def missing(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)

    def differs(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        return self.checks[np.searchsorted(self.keys, keys)] != checks

    def put(self, keys: np.ndarray, checks: np.ndarray, new: np.ndarray, sizes: np.ndarray) -> None:
        """New keys, in order, with their second names and their ids one after the other."""
        if len(self.keys) + len(keys) > MEMO:
            stay = self.asked if self.asked.sum() < MEMO // 2 else np.zeros(len(self.keys), bool)
            self.flat = spread(self.flat, self.starts[stay], self.sizes[stay])
            self.keys, self.checks, self.sizes = self.keys[stay], self.checks[stay], self.sizes[stay]
            self.used, self.starts, self.asked = len(self.flat), np.cumsum(self.sizes) - self.sizes, np.zeros(len(self.keys), bool)
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(new), np.uint32)])
        self.flat[self.used : self.used + len(new)] = new
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(sizes) - sizes)
        self.sizes, self.asked = np.insert(self.sizes, at, sizes), np.insert(self.asked, at, False)
        self.keys, self.checks, self.used = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks), self.used + len(new)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        self.asked[at] = True
        return self.starts[at], self.sizes[at]


class LibraryEncoder:
    """The library's ids. Texts are cut at spaces and behind words (where pre-tokens always begin). The distinct stretches of many texts
    are found by their names; those not known yet are cut into pre-tokens, each of which is given to the library's
    model. Texts with special strings go to the library whole."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = {b: c for c, b in byte_letters().items()}
        self.letter_of = np.array([ord(self.letters[b]) for b in range(256)], "<u4")
        self.find = regex.compile(PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo, self.pieces = Memo(), {}
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.vocabulary)]
        if self.ask(self.find(PROBE)) != np.array(self.whole(PROBE), "<u4").tobytes():
            raise ValueError("the library cuts texts into other pre-tokens than the pattern")

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of_model(self, piece: str) -> list[int]:
        plain = piece[:1] == " " and piece.isascii() and piece[1:].isalpha()
        return [t.id for t in self.tokenize("\u0120" + piece[1:] if plain else piece.encode().decode("latin-1").translate(self.letters))]

    def ask(self, pieces: list[str]) -> bytes:
        return b"".join([self.id_bytes[i] for p in pieces for i in self.of_model(p)])

    def models(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, one after the other, and where each ends, after a 0. Their bytes are made letters together;
        0xFF, which UTF-8 has not, comes after each."""
        raw = np.frombuffer(b"".join([p.encode() + b"\xff" for p in pieces]), np.uint8)
        ids: list[int] = []
        ends = [0]
        for letters in self.letter_of[raw].tobytes().decode("utf-32-le").split(self.letters[0xFF])[:-1]:
            ids += [t.id for t in self.tokenize(letters)]
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.array(ends, np.int64)

    def ask_all(self, stretches: list[str], glued: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches (after a space, but for glued ones), one after the other, and how many each has."""
        find = self.find
        gc.disable()  # no cycles are made, and looking for them among so many lists takes long
        try:
            cut = [pre_tokens(find, u) if not joined else [u] if u.isalpha() else find(u) for u, joined in zip(stretches, glued)]
            pieces = list(itertools.chain.from_iterable(cut))
            number = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
            if often := 4 * len(number) < 3 * len(pieces):
                which = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
            ids, ends = self.models(list(number) if often else pieces)
        finally:
            gc.enable()
        if often:
            sizes = np.diff(ends)[which]
            ids, ends = spread(ids, ends[which], sizes), np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))], prepend=0)

    def slowly(self, text: str) -> np.ndarray:
        """A text with runs of blanks or very long stretches."""
        first, *rest = CUT.split(text)
        ids = [self.ask(self.find(first))]
        for u in rest:
            if (found := self.pieces.get(u)) is None:
                found = self.ask(pre_tokens(self.find, u))
                if len(self.pieces) >= PIECES:
                    self.pieces.clear()
                if len(u) < 100:
                    self.pieces[u] = found
            ids.append(found)
        return np.frombuffer(b"".join(ids), "<u4")

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if not any(s in t for s in self.special)]
        if len(plain) < len(texts):
            for i in set(range(len(texts))) - set(plain):
                out[i] = np.array(self.whole(texts[i]), np.uint32)
        if not plain:
            return out
        raw = [texts[i].encode() for i in plain]
        blob = b" ".join([*raw, b""])
        data = np.frombuffer(blob, np.uint8)
        ends = np.flatnonzero(data == 32)
        begins = np.concatenate([[0], ends[:-1] + 1])
        firsts = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])])
        heads = np.searchsorted(begins, firsts)
        odd = MAY_BE_BLANK[data[begins]]
        odd[heads] = False
        odd |= ends - begins > LONGEST
        if odd.any():
            often, long = (np.add.reduceat(x.astype(int), heads).tolist() for x in (odd, ends - begins > LONGEST))
            slow = {i for i, n, m in zip(plain, often, long) if m or n and UNSAFE.search(texts[i])}
            if slow:
                for i in slow:
                    out[i] = self.slowly(texts[i])
                quick = [i for i in plain if i not in slow]
                for i, found in zip(quick, self.encode_all([texts[i] for i in quick])):
                    out[i] = found
                return out
        inner = cuts(data)
        begins, ends = (np.sort(np.concatenate([x, inner]), kind="stable") for x in (begins, ends))
        glued = np.zeros(len(begins), bool)  # what has no space before it
        heads = np.searchsorted(begins, firsts)
        glued[heads] = glued[np.searchsorted(begins, inner)] = True
        hashes, checks = names(np.frombuffer(blob + PAD, np.uint8), begins, ends - begins, 2)
        hashes[glued] ^= np.uint64(0x5851F42D4C957F2D)
        codes, distinct = pd.factorize(hashes)
        order = np.argsort(distinct)
        keys = distinct[order]
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]  # where each occurs first
        twins = checks != checks[first][codes]  # other stretches of the same name
        new = self.memo.missing(keys)
        if new.any():
            at = first[order[new]]
            self.memo.put(keys[new], checks[at], *self.ask_all([blob[b:e].decode() for b, e in zip(begins[at].tolist(), ends[at].tolist())], glued[at].tolist()))
            again = self.memo.missing(keys)
            if again.any():  # the table was emptied meanwhile
                return self.in_halves(texts, out, plain)
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        starts[order], sizes[order] = self.memo.find(keys)
        differs = np.zeros(len(keys), bool)
        differs[order] = self.memo.differs(keys, checks[first[order]])
        twins |= differs[codes]
        own = sizes[codes]
        ids = spread(self.memo.flat, starts[codes], own)
        for i, part in zip(plain, np.split(ids, (np.cumsum(own) - own)[heads[1:]])):
            out[i] = part
        for nth in np.unique(np.searchsorted(heads, np.flatnonzero(twins), "right") - 1).tolist():
            out[plain[nth]] = self.slowly(texts[plain[nth]])
        return out

    def in_halves(self, texts: list[str], out: list[np.ndarray | None], plain: list[int]) -> list[np.ndarray]:
        half = (len(plain) + 1) // 2
        for some in (plain[:half], plain[half:]):
            for i, found in zip(some, self.encode_all([texts[i] for i in some])):
                out[i] = found
        return out


_encoders: dict[str, LibraryEncoder] = {}


def winners(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the occurrences at positions ``at`` (ascending) are replaced: of overlapping ones (neighbouring
    positions) the one of better rank, of equal rank the left one; what overlaps with it is out, then the same again."""
    won, live = np.zeros(len(at), bool), np.arange(len(at))
    while len(live):
        p, r = at[live], rank[live]
        touch = np.diff(p) == 1
        lose_left = np.concatenate([[False], touch & (r[:-1] <= r[1:])])
        lose_right = np.concatenate([touch & (r[1:] < r[:-1]), [False]])
        win = ~(lose_left | lose_right)
        # In a run of one pair only every second place has no better one left of it.
        if not win.all():
            out = win.copy()
            out[1:] |= win[:-1] & touch
            out[:-1] |= win[1:] & touch
        else:
            out = win
        won[live[win]] = True
        live = live[~out]
    return won


def compress(ids: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs), expansion lengths of their symbols, and the sequence left, in 16-bit symbols where
    the vocabulary allows it. Rule ``r`` is the symbol ``first_rule + r``."""
    narrow = first_rule <= 60_000
    most = (1 << 16 if narrow else 1 << 31) - first_rule
    kind, key_kind, bits = (np.uint16, np.uint32, 16) if narrow else (np.uint32, np.uint64, 32)
    seq = ids.astype(kind)
    rules, lengths = [np.zeros((0, 2), kind)], np.ones(first_rule, np.int64)

    def keys_at(at: np.ndarray | slice, after: np.ndarray | slice) -> np.ndarray:
        return (seq[at].astype(key_kind) << key_kind(bits)) | seq[after]

    def slots(keys: np.ndarray) -> np.ndarray:
        return (((keys ^ (keys >> key_kind(15))).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - SLOTS)).astype(np.intp)

    # Counts by hash of all pairs, kept up to date, bound the counts of pairs from above.
    slot = slots(keys_at(slice(None, -1), slice(1, None)))
    crowd = np.bincount(slot, minlength=1 << SLOTS)
    bound = len(seq)
    while bound >= LEAST and len(lengths) - first_rule < most and len(seq) > 1:
        bound = min(bound, int(crowd.max()))
        level = max(LEAST, bound // 8)
        at = np.flatnonzero((crowd >= level)[slot])
        place, found = pd.factorize(keys_at(at, at + 1))
        times = np.bincount(place, minlength=len(found))
        order = np.lexsort((found, -times))
        order = order[times[order] >= level][: most - len(lengths) + first_rule]
        rank = np.full(len(found), len(order))
        rank[order] = np.arange(len(order))
        place = rank[place]
        at, place = at[place < len(order)], place[place < len(order)]
        won = winners(at, place)
        at, place = at[won], place[won]
        # A pair that lost most of its places waits: it may be frequent no more.
        enough = np.bincount(place, minlength=len(order)) >= LEAST
        at, place = at[enough[place]], (np.cumsum(enough) - 1)[place[enough[place]]]
        if not len(at):
            bound = level - 1
            continue
        made = found[order[enough]]
        new = np.stack([(made >> key_kind(bits)).astype(kind), made.astype(kind)], 1)
        # Pairs that go: those replaced and the ones beside them.
        gone = np.zeros(len(slot) + 2, bool)
        gone[at] = gone[at + 1] = gone[at + 2] = True
        crowd -= np.bincount(slot[gone[1:-1]], minlength=1 << SLOTS)
        seq[at] = (len(lengths) + place).astype(kind)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, kept = seq[stay], stay[:-1]
        kept[-1] &= stay[-1]  # of the last pair the first symbol stays, not its place among the pairs
        slot = slot[kept]
        # Pairs that come: those with a new symbol.
        here = at - np.arange(len(at))
        come = np.zeros(len(slot) + 2, bool)
        come[here] = come[here + 1] = True
        come = np.flatnonzero(come[1 : len(slot) + 1])
        slot[come] = slots(keys_at(come, come + 1))
        crowd += np.bincount(slot[come], minlength=1 << SLOTS)
        lengths = np.concatenate([lengths, lengths[new[:, 0]] + lengths[new[:, 1]]])
        rules.append(new)
    return np.concatenate(rules), lengths[first_rule:], seq


def expansions(rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """All symbols' ids, and where each rule's begin."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.zeros(int(starts[-1]), np.uint32)
    at = starts.tolist()
    for r, (a, b) in enumerate(rules.tolist()):
        to = at[r]
        for s in (a, b):
            if s < first_rule:
                ids[to] = s
                to += 1
            else:
                n = at[s - first_rule + 1] - at[s - first_rule]
                ids[to : to + n] = ids[at[s - first_rule] : at[s - first_rule] + n]
                to += n
    return ids, starts


class Block:
    """A written block, opened for reading."""

    def __init__(self, first_rule: int, rules: bytes, lengths: bytes, symbols: bytes):
        kind = np.uint16 if first_rule <= 60_000 else np.uint32
        self.first = first_rule
        self.seq = np.frombuffer(symbols, kind).astype(np.int64)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.flat, self.starts = expansions(np.frombuffer(rules, kind).reshape(-1, 2), self.lengths, first_rule)
        new = self.seq >= first_rule
        self.sizes = np.ones(len(self.seq), np.int64)
        self.sizes[new] = self.lengths[self.seq[new] - first_rule]
        self.ends = np.cumsum(self.sizes)

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``: only the symbols that reach into the range are expanded."""
        stop = int(self.ends[-1]) if stop is None and len(self.ends) else stop or 0
        if stop <= start:
            return np.zeros(0, np.uint32)
        lo, hi = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left") + 1
        part, sizes = self.seq[lo:hi], self.sizes[lo:hi]
        ends = np.cumsum(sizes)
        new = part >= self.first
        # A terminal stands for itself; a rule's ids are gathered from the flat table.
        base = np.where(new, self.starts[np.maximum(part - self.first, 0)] if len(self.starts) > 1 else 0, 0)
        place = np.repeat(base - ends + sizes, sizes) + np.arange(ends[-1])
        out = np.repeat(part, sizes)
        inside = np.repeat(new, sizes)
        out[inside] = self.flat[place[inside]]
        skip = start - int(self.ends[lo] - self.sizes[lo])
        return out[skip : skip + stop - start].astype(np.uint32)


def write(df: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode each text, append ``end_id``, and write all ids in ascending order of ``id_col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        if vocabulary not in _encoders:
            _encoders[vocabulary] = LibraryEncoder(vocabulary)
        encoder = _encoders[vocabulary]
        ids, docs, held, block, start = [], [], 0, 0, 0

        def packed() -> pa.RecordBatch:
            rules, lengths, seq = compress(np.concatenate(ids), encoder.vocabulary)
            values = [shard, block, start, held, docs, [len(x) for x in ids], encoder.vocabulary, rules.tobytes(), lengths.tobytes(), seq.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["shard", "block", "start_in_shard", "n_tokens", "doc_ids", "doc_tokens", "first_rule", "rules", "lengths", "symbols"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for part in chunks(batch, text_col):
                for doc, found in zip(part.column(id_col).to_pylist(), encoder.encode_all(part.column(text_col).to_pylist())):
                    own = np.append(found, np.uint32(end_id)).astype(np.uint32)
                    if ids and held + len(own) > block_tokens:
                        yield packed()
                        start += held
                        block, ids, docs, held = block + 1, [], [], 0
                    ids.append(own)
                    docs.append(doc)
                    held += len(own)
        if ids:
            yield packed()

    rows = df.select(F.col(id_col), text_or_empty(text_col).alias(text_col))
    rows.repartitionByRange(id_col).sortWithinPartitions(id_col, text_col).mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row for each document of the files: ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (binary, little-endian unsigned 32-bit)."""
    blocks = spark.read.parquet(path)
    # One row for each shard, as many as the write had tasks.
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    starts = shards.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("shard_start"))
    placed = blocks.join(F.broadcast(starts), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ids = Block(row["first_rule"], row["rules"], row["lengths"], row["symbols"]).read()
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                first = row["shard_start"] + row["start_in_shard"]
                for k in range(0, len(sizes), 2000):
                    part = slice(k, k + 2000)
                    own = [ids[e - n : e].tobytes() for e, n in zip(ends[part].tolist(), sizes[part].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][part], pa.int64()), pa.array(ends[part] - sizes[part] + first), pa.array(sizes[part]), pa.array(own, pa.binary())],
                        names=[id_col, "start", "n_tokens", "ids"],
                    )

    return placed.mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids binary")


def read_range(spark: SparkSession, path: str, shard: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one shard, expanding only what reaches into them."""
    from functools import reduce

    hit = spark.read.parquet(path).where((F.col("shard") == shard) & (F.col("start_in_shard") < stop) & (F.col("start_in_shard") + F.col("n_tokens") > start)).orderBy("block")
    parts = [Block(r.first_rule, r.rules, r.lengths, r.symbols).read(max(0, start - r.start_in_shard), min(r.n_tokens, stop - r.start_in_shard)) for r in hit.toLocalIterator()]
    return reduce(lambda a, b: np.concatenate([a, b]), parts, np.zeros(0, np.uint32))


def documents_through_files(documents: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    import uuid

    spark = documents.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write(documents, path, vocabulary)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
