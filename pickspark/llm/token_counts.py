"""Token counts without token ids.

A text is cut into pre-tokens, between which no vocabulary piece can span, so that a document's count is
the sum over its pre-tokens. Each *block* of documents lists its distinct pre-tokens once and keeps, per
document, their places in that list and their frequencies (packed). The distinct pre-tokens of all blocks
are counted once each with the library, joined back to the blocks' lists, and summed per document.
What is shuffled is one row for each block and distinct pre-token: frequent pre-tokens meet in as many
rows as there are blocks, never as there are documents, and no dictionary is broadcast or collected.

Edge cases: a null or empty text has 0 bytes and 0 tokens; a text without any cut is one pre-token;
repeated rows and repeated ids stay separate rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, written

#: The letter that stands for a space in the vocabulary.
MARK = "▁"
#: No piece joins a letter with a full stop or comma after it: texts are cut there too, which leaves fewer
#: distinct pre-tokens. The letter put before such a pre-token only tells it apart.
BEFORE_STOP = re.compile("(?<=[a-zA-Z\u00c0-\u024f])(?=[.,])")
APART = "\x02"
#: Pre-tokens where spaces come in runs: a run of marks goes with what follows it.
RUNS = re.compile(rf"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
#: Bytes of text in a block, at most (one document at least).
BLOCK_BYTES = 32 << 20
#: Rows of (block, place, count) that a task packs at a time.
HELD_ROWS = 2_000_000

_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """One model for each Python worker. Raises if the vocabulary breaks the rule the cuts rest on."""
    if path not in _models:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        bad = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if re.search(rf"[^{MARK}]{MARK}|\n.|.\n|[a-zA-Z\u00c0-\u024f][.,]", p, re.S)]
        probe = "a  b\ta ﬁ"
        if bad or sp.decode(sp.encode(probe)) != probe:
            raise ValueError(f"pieces {bad[:3]} span pre-tokens, or the model normalises texts")
        _models[path] = sp
    return _models[path]


def pre_tokens(text: str) -> Counter[str]:
    """Frequencies of pre-tokens; each begins with the mark, with a line end, or the text itself."""
    if not text:
        return Counter()
    if MARK not in text and APART not in text:
        units = BEFORE_STOP.sub(" " + APART, text.replace("\n", " \n")).split(" ")
        if "" not in units:
            return Counter([u if u[0] == "\n" or u[0] == APART else MARK + u for u in units])
    return Counter(RUNS.findall(MARK + text.replace(" ", MARK)))


def count_pieces(words: list[str], path: str) -> list[int]:
    """Tokens of each pre-token on its own. The line end put before it keeps the model from adding
    its own mark; it costs two tokens, which are taken off."""
    own = ["\n" + (w[1:] if w[0] == APART and len(w) > 1 else w) for w in words]
    return [len(ids) - 2 for ids in model(path).encode(own, num_threads=1)]


def packed(numbers: np.ndarray) -> bytes:
    """Differences of neighbours, compressed."""
    return zstandard.compress(np.diff(numbers, prepend=0).astype(np.int32).tobytes(), 6)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int32), dtype=np.int64)


def by_block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Places and counts of each block, packed."""
    block, place, count = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((place, block))
    block, place, count = block[order], place[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    cut = lambda x: pa.array([packed(y) for y in np.split(x, starts[1:])], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(block[starts]), cut(place), cut(count)], names=["block", "of", "counts"])


FREQUENCIES = "block long, doc_ids array<long>, n_bytes array<long>, words array<string>, ends binary, places binary, times binary"


def frequencies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block of documents: its distinct pre-tokens, and each document's places and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col, block_bytes):
                number: dict[str, int] = {}
                places, times, ends, sizes = [], [], [0], []
                for text in part.column(text_col).to_pylist():
                    found = pre_tokens(text or "")
                    own = np.array([number.setdefault(w, len(number)) for w in found], np.int64)
                    order = np.argsort(own)
                    places.append(own[order])
                    times.append(np.fromiter(found.values(), np.int64, len(found))[order])
                    ends.append(ends[-1] + len(found))
                    sizes.append(len((text or "").encode()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().int >> 65]),
                        pa.array([part.column(id_col).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes], pa.list_(pa.int64())),
                        pa.array([list(number)], pa.list_(pa.string())),
                        *(pa.array([packed(x)], pa.binary()) for x in (np.array(ends), np.concatenate(places), np.concatenate(times))),
                    ],
                    names=["block", "doc_ids", "n_bytes", "words", "ends", "places", "times"],
                )

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, FREQUENCIES)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each row."""
    blocks = written(frequencies(df, id_col, text_col), "frequencies")
    # Equal words of all blocks meet in one task, in order, and are counted once. A word occurs once in a block,
    # so no word has more rows than there are blocks.
    listed = blocks.select("block", F.posexplode("words").alias("place", "word"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            words = batch.column("word").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            new = [w for w in distinct if w not in known]
            known = {w: known[w] for w in distinct if w in known} | dict(zip(new, count_pieces(new, path)))
            counts = np.array([known[w] for w in distinct], np.int64)[words.indices.to_numpy()]
            held.append((batch.column("block").to_numpy(), batch.column("place").to_numpy(), counts))
            if sum(len(h[0]) for h in held) > HELD_ROWS:
                yield by_block(held)
                held = []
        if held:
            yield by_block(held)

    counted = listed.repartition("word").sortWithinPartitions("word").mapInArrow(count, "block long, of binary, counts binary")
    sized = counted.groupBy("block").agg(F.collect_list(F.struct("of", "counts")).alias("counts"))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                parts = [(unpacked(x["of"]), unpacked(x["counts"])) for x in row.column("counts")[0].as_py() or []]
                of = np.zeros(sum(len(p) for p, _ in parts), np.int64)
                for p, n in parts:
                    of[p] = n
                ends, places, times = (unpacked(row.column(n)[0].as_py()) for n in ("ends", "places", "times"))
                running = np.concatenate([[0], np.cumsum(of[places] * times)])
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_ids").flatten(), row.column("n_bytes").flatten(), pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64())],
                    names=[id_col, "n_bytes", "n_tokens"],
                )

    # Blocks of empty texts alone have no pre-token, hence the outer join.
    return blocks.drop("words").join(sized, "block", "left").mapInArrow(total, f"`{id_col}` long, n_bytes long, n_tokens long")


def documents_token_counts(documents: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    return token_counts(documents, path).withColumn("over_limit", F.col("n_tokens") > limit)
