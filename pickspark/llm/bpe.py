"""Byte-level BPE encoding and decoding.

Encoding is exact and linear: an Aho-Corasick automaton over all tokens gives the longest token at
each byte; the backtracking encoder takes it if it is *compatible* with the token before (BPE, run on
the two texts together, would keep the border between them) and otherwise tries the next shorter
token, stepping back where none fits. Compatibility of a pair is decided by undoing merges and is kept
in a table. The words that about a megabyte of texts has new are searched in step, as arrays. Decoding
gathers bytes through a table of offsets.

Edge cases: a null text is encoded as an empty one (no ids, empty decoded text); whole texts of any
length are encoded; repeated rows give repeated rows; an empty table gives an empty one; other columns
are passed through, except that columns named like an output are replaced.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, lean, text_or_empty

#: The pre-token pattern of byte-level BPE vocabularies, and the bytes that stand for
#: themselves in their files (the others are numbered from 256 in order).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: A space before a non-space always begins a pre-token, so texts may be cut there.
CUT = re.compile(r" (?=\S)")
UNSAFE = re.compile(r" (?=\s)| $")
#: Entries that a memo table holds at most.
MEMO = 150_000
#: Pre-tokens of as many characters are searched one by one, and so are the last so many of those searched in step.
LONG, ALONE = 100, 100
HASH = 0x1E3779B97F4A7C15


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    letters = {chr(b): b for b in PLAIN_BYTES}
    rest = [b for b in range(256) if chr(b) not in letters]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def trim(memo: dict[str, bytes], most: int) -> None:
    """A table of more entries keeps the third that came first, where the frequent ones are."""
    if len(memo) > most:
        first = list(itertools.islice(memo.items(), most // 3))
        memo.clear()
        memo.update(first)


def keep(memo: dict[str, bytes], text: str, ids: bytes, most: int) -> None:
    """Remember a short text."""
    if len(text) < LONG:
        trim(memo, most)
        memo[text] = ids


def pre_tokens(find: Callable[[str], list[str]], stretch: str) -> list[str]:
    """Pre-tokens of a space and ``stretch``, which holds no space. Plain words, with a full stop or comma or
    without, need no pattern: letters with the space before them are one pre-token."""
    if stretch.isalpha():
        return [" " + stretch]
    if stretch[-1:] in (".", ",") and stretch[:-1].isalpha():
        return [" " + stretch[:-1], stretch[-1]]
    return find(" " + stretch)


class Codec:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of, vocab = byte_letters(), spec["model"]["vocab"]
        as_bytes = {s: bytes(of[c] for c in s) for s in vocab if all(c in of for c in s)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # Ranks: single bytes first, then one for each merge in order.
        letters = sorted(of, key=of.get)
        rank = {c: i for i, c in enumerate(letters)}
        self.left, self.right = list(range(256)), list(range(256))
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            if a + b in rank:
                raise ValueError(f"two merges make {a + b!r}; ranks would be ambiguous")
            rank[a + b] = len(rank)
            self.left.append(rank[a])
            self.right.append(rank[b])
            self.merged[rank[a], rank[b]] = rank[a + b]
        self.id_bytes = [vocab[s].to_bytes(4, "little") for s in rank]
        texts = [as_bytes[s] for s in rank]
        self.length = [len(t) for t in texts]
        number = {t: i for i, t in enumerate(texts)}
        self.shorter = [next((number[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in number), -1) for t in texts]
        self.automaton = ahocorasick.Automaton()
        for t, i in number.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.lengths, self.shorters = np.array(self.length), np.array(self.shorter)
        self.numbers = np.array([vocab[s] for s in rank], "<u4")
        self.pairs, self.good = np.full(1 << 18, -1), np.zeros(1 << 18, bool)
        # Special tokens: their strings inside a text become their ids, as the library does by default.
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["content"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # The offset table: token i is blob[offsets[i]:offsets[i + 1]].
        table = {vocab[s]: b for s, b in as_bytes.items()} | {i: s.encode() for s, i in self.special.items()}
        sizes = np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.blob = np.frombuffer(b"".join(table.get(i, b"") for i in range(len(sizes))), np.uint8)
        self.find = regex.compile(PATTERN).findall
        self.begun: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE over both tokens' text ends in exactly these two; kept in the table."""
        key = (a, b)
        if len(self.compatible) > MEMO:
            self.compatible.clear()
        limit, good = 1 << 60, None
        while good is None:
            made = self.merged.get((a, b))
            if made is not None and made < limit:
                good = False
            elif a > b:  # undo the later merge of the two
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        good = True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        good = True
        self.compatible[key] = good
        return good

    def ranks(self, text: bytes) -> list[int]:
        """The exact merges of one pre-token."""
        letters, known, fits = text.decode("latin-1"), self.compatible.get, self.fits
        # The first way the search takes: longest tokens from the left, if each fits the one before.
        out = [token for _, token in self.automaton.iter_long(letters)]
        if all(map(known, zip(out, out[1:]))):
            return out
        for i, pair in enumerate(zip(out, out[1:]), 1):
            good = known(pair)
            if not (fits(*pair) if good is None else good):
                return self._backtrack(letters, out, i)
        return out

    def _backtrack(self, letters: str, first: list[int], i: int) -> list[int]:
        """The search from where it leaves the first way: token ``i`` does not fit the one before."""
        length, shorter, known, fits = self.length, self.shorter, self.compatible.get, self.fits
        longest, start = {}, 0  # by the byte they begin at; others are looked up when the search comes there
        for token in first:
            longest[start] = token
            start += length[token]
        n, out, token = start, first[:i], first[i]
        at = sum(map(length.__getitem__, out))
        closed: set[int] = set()
        while at < n:
            end = at + length[token]
            good = end not in closed
            if good and out:
                good = known((out[-1], token))
                if good is None:
                    good = fits(out[-1], token)
            if good:
                out.append(token)
                at = end
                if at < n:
                    token = longest.get(at)
                    if token is None:
                        token = longest[at] = next(self.automaton.iter_long(letters, at))[1]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # nothing fits here: never end a token here again
                closed.add(at)
                token = out.pop()
                at -= length[token]
        return out

    def searched(self, pre_tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token: the search of ``ranks`` for all of them in step. Positions are those of the pre-tokens laid
        one after the other, with one between them. Long ones, and the last that are left, are searched alone."""
        raw = [p.encode() if len(p) < LONG else b"" for p in pre_tokens]
        letters = [r.decode("latin-1") for r in raw]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        begin = np.cumsum(sizes + 1) - sizes - 1
        stop = begin + sizes
        longest = np.full(int((sizes + 1).sum()), -1)
        hits = list(self.automaton.iter_long("\u0100".join(letters)))  # no token has this letter
        ends, tokens = np.fromiter(itertools.chain.from_iterable(hits), np.int64, 2 * len(hits)).reshape(-1, 2).T
        longest[ends + 1 - self.lengths[tokens]] = tokens
        last = np.full(len(longest), -1)  # the token of the way taken that ends at a position
        closed = np.zeros(len(longest), bool)
        at, token, open_ = begin.copy(), longest[np.minimum(begin, len(longest) - 1)], np.flatnonzero(sizes)
        while len(open_) > ALONE:
            a, t = at[open_], token[open_]
            end, before = a + self.lengths[t], last[a]
            good = ~closed[end]
            ask = good & (before >= 0)
            good[ask] = self.fit(before[ask], t[ask])
            bad = ~good
            last[end[good]] = t[good]
            shorter = self.shorters[t[bad]]
            back = shorter < 0
            dead = a[bad][back]
            closed[dead] = True
            a[good], t[bad] = end[good], shorter
            popped = np.flatnonzero(bad)[back]
            t[popped] = last[dead]
            a[popped] -= self.lengths[last[dead]]
            found = longest[a]
            for i in np.flatnonzero(good & (found < 0) & (a < stop[open_])).tolist():
                word = open_[i]
                longest[a[i]] = found[i] = next(self.automaton.iter_long(letters[word], int(a[i] - begin[word])))[1]
            t[good] = found[good]
            at[open_], token[open_] = a, t
            open_ = open_[a < stop[open_]]
        alone = {i: self.ranks(raw[i] or pre_tokens[i].encode()) for i in {*open_.tolist(), *np.flatnonzero(sizes == 0).tolist()}}
        # Back from the ends, in step.
        way = np.zeros(len(longest), bool)
        sizes[list(alone)] = 0
        rest = np.flatnonzero(sizes)
        p, first = stop[rest], begin[rest]
        while len(p):
            way[p] = True
            p = p - self.lengths[last[p]]
            p, first = p[p > first], first[p > first]
        ids = self.numbers[last[way]].tobytes()
        bounds = 4 * np.concatenate([[0], np.cumsum(way)])
        out = [ids[i:j] for i, j in zip(bounds[begin].tolist(), bounds[stop + 1].tolist())]
        for i, ranks in alone.items():
            out[i] = b"".join(map(self.id_bytes.__getitem__, ranks))
        return out

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``fits`` for many pairs, through a table that holds a pair at the place that its hash names."""
        key = a << 32 | b
        place = (key * HASH >> 40) & (len(self.pairs) - 1)
        good = self.good[place]
        new = np.flatnonzero(self.pairs[place] != key)
        if len(new):
            keys, which = np.unique(key[new], return_inverse=True)
            found = np.array([self.fits(k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()])
            good[new] = found[which]
            self.pairs[place[new]], self.good[place[new]] = key[new], good[new]
        return good

    def learn(self, texts: list[str]) -> None:
        """Fill the memo tables with what these texts have new. Stretches of very long texts are encoded as they come."""
        trim(self.spaced, MEMO * 3 // 4)
        trim(self.pieces, MEMO // 4)
        new = set().union(*[t.split(" ") for t in texts if len(t) < 4 << 20]).difference(self.spaced)
        cut = {u: pre_tokens(self.find, u) for u in new if len(u) < LONG}
        wanted = list(set(itertools.chain.from_iterable(cut.values())).difference(self.pieces))
        if len(wanted) > ALONE:
            made = dict(zip(wanted, self.searched(wanted)))
            known = self.pieces | made
            self.spaced.update({u: known[found[0]] if len(found) == 1 else b"".join([known[p] for p in found]) for u, found in cut.items()})
            self.pieces.update({p: made[p] for found in cut.values() if len(found) > 1 for p in found if p in made})

    def piece(self, pre_token: str) -> bytes:
        if (ids := self.pieces.get(pre_token)) is None:
            ids = b"".join(map(self.id_bytes.__getitem__, self.ranks(pre_token.encode())))
            keep(self.pieces, pre_token, ids, MEMO)
        return ids

    def stretch(self, u: str) -> bytes:
        """Ids of a space and ``u``, which holds no space."""
        if (ids := self.spaced.get(u)) is None:
            ids = b"".join(map(self.piece, pre_tokens(self.find, u)))
            keep(self.spaced, u, ids, 2 * MEMO)  # ``learn`` trims at less
        return ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what is new in about a megabyte of them is searched together."""
        out: list[bytes] = []
        sizes = np.cumsum([len(t) for t in texts], dtype=np.int64) >> 20
        for _, group in itertools.groupby(range(len(texts)), sizes.__getitem__):
            some = [texts[i] for i in group]
            self.learn(some)
            out += map(self.encode, some)
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.at_special is None:
            return self._plain(text)
        parts = self.at_special.split(text)
        return b"".join(self.special[p].to_bytes(4, "little") if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = CUT.split(text) if UNSAFE.search(text) else text.split(" ")
        head = self.begun.get(first)
        if head is None:
            head = b"".join(map(self.piece, self.find(first)))
            keep(self.begun, first, head, MEMO // 4)
        out = list(map(self.spaced.get, rest))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            out[i] = self.stretch(rest[i])
        return head + b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.gather(np.frombuffer(ids, "<u4").astype(np.int64)).tobytes().decode("utf-8", "replace")

    def gather(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids):
            return np.zeros(0, np.uint8)
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        shift = self.offsets[ids] - ends + sizes
        return self.blob[np.repeat(shift, sizes) + np.arange(ends[-1])]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each vocabulary file and Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _with(df: DataFrame, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in {n for n, _ in fields}]
    return T.StructType(kept + [T.StructField(n, t) for n, t in fields])


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col`` (binary: little-endian unsigned 32-bit ids) to each row."""
    schema = _with(df, [(ids_col, T.BinaryType())])
    names = [f.name for f in schema.fields][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for part in chunks(batch, text_col):
                ids = c.encode_all([t or "" for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(ids, pa.binary())], names=[*names, ids_col])

    return df.mapInArrow(lean(run), schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col`` with the text of ``ids_col``."""
    schema = _with(df, [(text_col, T.StringType())])
    names = [f.name for f in schema.fields][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for part in chunks(batch, ids_col):
                texts = [c.decode(i or b"") for i in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(texts, pa.string())], names=[*names, text_col])

    return df.mapInArrow(lean(run), schema)


def round_trip(df: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Encode and decode in one pass: adds ``ids_col`` and ``decoded_col``, drops ``text_col``."""
    schema = _with(df.drop(text_col), [(ids_col, T.BinaryType()), (decoded_col, T.StringType())])
    names = [f.name for f in schema.fields][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for part in chunks(batch, text_col, 4 << 20):
                ids = c.encode_all([t or "" for t in part.column(text_col).to_pylist()])
                texts = [c.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=[*names, ids_col, decoded_col])

    return df.mapInArrow(lean(run), schema)


def digest(encoded: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Counts and digests of the outcome of ``round_trip``."""
    return encoded.select(
        "doc_id",
        (F.octet_length(ids_col) / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col(ids_col), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col).cast("binary"), 256).alias("decoded_sha256"),
    )


def documents_round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    return digest(round_trip(documents.select("doc_id", text_or_empty().alias("text")), vocabulary))
