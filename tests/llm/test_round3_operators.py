import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pickspark.llm import alignment, hashing, queries, substring_dedup, whitening
from pickspark.llm.bpe import byte_letters

SF = "/root/testdata/sf0.001"


# Whitening


def plain_directions(x):
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("kind", ["gauss", "graded", "pairs", "equal", "few", "narrow"])
def test_solver_equals_eigenvalues(kind):
    rng = np.random.default_rng(1)
    x = {
        "gauss": lambda: rng.normal(size=(2000, 64)) * 300 + 100_000,
        "graded": lambda: rng.normal(size=(2000, 40)) * np.logspace(0, 4, 40) + 100_000,
        "pairs": lambda: np.diag([1000, 1000, 500, 500, 30, 30, 9, 9])[rng.integers(0, 8, 4000)],
        "equal": lambda: np.vstack([np.eye(6), -np.eye(6)]) * 1000,
        "few": lambda: rng.integers(0, 10, (5, 64)),
        "narrow": lambda: rng.normal(size=(50, 1)) * 9,
    }[kind]().astype(np.int64)
    n, sums, d = len(x), x.sum(0), x.shape[1]
    centred, values, vectors = plain_directions(x)
    r = np.linalg.qr(centred, mode="r")
    found = whitening.solved(np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r, n, sums, d)
    k = int((found.values > 0).sum())
    assert k == np.linalg.matrix_rank(centred)
    assert found.values[:k] == pytest.approx(values[:k], rel=1e-7)
    v = found.vectors[:, :k]
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-10
    cov = centred.T @ centred / n
    assert np.abs(cov @ v - v * found.values[:k]).max() < 1e-11 * found.values[0]
    white = found.whiten(x)[:, :k]
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-6
    assert found.trace == pytest.approx(values.sum())


def test_small_values_keep_their_digits():
    """Singular values over twelve orders of magnitude: a covariance would lose the small ones."""
    a = np.logspace(0, -12, 20)
    got = np.sqrt(whitening.dqds(a, np.full(19, 1e-13)))
    assert got == pytest.approx(np.linalg.svd(np.diag(a) + np.diag(np.full(19, 1e-13), 1), compute_uv=False), rel=1e-3)
    b = a[:-1] / 2
    whole = np.diag(a) + np.diag(b, 1)
    assert np.prod(np.sqrt(whitening.dqds(a, b))[:10]) == pytest.approx(np.prod(np.linalg.svd(whole, compute_uv=False)[:10]), rel=1e-9)
    assert np.prod(np.sqrt(whitening.dqds(a, b) / a[::1] ** 2)) == pytest.approx(1, rel=1e-10)  # the determinant, exact to the last one


def test_whitened_rows(spark):
    rng = np.random.default_rng(2)
    good = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, v.tolist(), i) for i, v in enumerate(good)] + [(900, None, 0), (901, [1.0, None] * 6, 0), (902, [float("nan")] + [0.0] * 11, 0), (903, [float("inf")] + [0.0] * 11, 0), (904, [], 0), (905, [1.0] * 7, 0), (906, good[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(5)
    got = whitening.whitened(df).toPandas().sort_values(["vec_id", "component"])
    x = np.floor(1024 * np.vstack([good, good[:1]]).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred, values, vectors = plain_directions(x)
    assert got.vec_id.unique().tolist() == [*range(300), 906] and got.component.tolist() == list(range(1, 9)) * 301 and set(got.n) == {n}
    assert got.deviation.to_numpy()[::8].tolist() == ((n * x - sums) ** 2).sum(1).tolist()
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    mine = got.whitened.to_numpy().reshape(-1, 8)
    assert np.abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-9
    assert got.explained.to_numpy()[:8] == pytest.approx(values[:8] / values.sum(), rel=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whitened(empty).count() == 0
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, 2.0]), (None, [0.5, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert len(one) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained is None for r in one)


def test_triangles_are_reduced_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    spread = whitening.directions(whitening.usable(df.repartition(20), "vec_id", "embedding"))
    monkeypatch.setattr(whitening, "FAN_IN", 64)
    alone = whitening.directions(whitening.usable(df.coalesce(1), "vec_id", "embedding"))
    assert spread.values == pytest.approx(alone.values, rel=1e-12)


# Substring deduplication


def plain_dedup(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def made_rows(seed):
    rng = random.Random(seed)
    words = [("w%d" % i) * rng.choice([1, 1, 2, 4]) for i in range(rng.choice([2, 5, 200, 5000]))]
    passages = [[rng.choice(words) for _ in range(rng.randint(15, 80))] for _ in range(6)]
    rows = []
    for doc in range(110):
        t = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.35:
                t += rng.choice(passages)
            elif kind < 0.5:
                t += rng.choice(passages)[rng.randint(0, 10) : rng.randint(12, 60)]
            elif kind < 0.6:
                t += [rng.choice(words)] * rng.randint(1, 70)
            elif kind < 0.7:
                t += [rng.choice(words), rng.choice(words)] * rng.randint(1, 40)
            else:
                t += [rng.choice(words) for _ in range(rng.randint(1, 60))]
        rows.append((doc, rng.choice([" ", "\n", "\t ", " \x0b\x0c"]).join(t) if doc % 17 else None))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_dedup_equals_brute_force(spark, monkeypatch, seed):
    if seed % 2:  # small blocks, lots and pieces of texts
        for name, value in (("BLOCK_BYTES", 2000), ("LOT", 300), ("PIECE_BYTES", 200)):
            monkeypatch.setattr(substring_dedup, name, value)
    rows = made_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"doc": F.lit("clash"), "bucket": F.lit(1)})
    found = substring_dedup.deduplicated(df, with_text=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == plain_dedup(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found)


def test_units_of_equal_windows_share_border_and_offset():
    rng = random.Random(9)
    for alphabet in ("ab", "abcde"):
        passages = [[rng.choice(alphabet) for _ in range(rng.randint(10, 60))] for _ in range(8)]
        words, bounds = [], [0]
        for _ in range(80):
            for _ in range(rng.randint(1, 5)):
                words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(alphabet)] * rng.randint(1, 30) if rng.random() < 0.5 else [rng.choice(alphabet) for _ in range(9)]
            bounds.append(len(words))
        with np.errstate(over="ignore"):
            _, (one, two) = hashing.word_names(np.frombuffer(" ".join(words).encode() + hashing.PAD, np.uint8), 2)
            p = substring_dedup.parsed(one, two, np.array(bounds))
        names = {}
        for first, last, k in zip(p.first.tolist(), p.last.tolist(), p.k.tolist()):
            for at in range(first, last + 1):
                assert names.setdefault(tuple(words[at : at + 20]), k) == k
        covered = [at for a, b in zip(p.first.tolist(), p.last.tolist()) for at in range(a, b + 1)]
        assert covered == [i for a, b in zip(bounds, bounds[1:]) for i in range(a, b - 19)]


def test_frequent_names_are_dealt_by_unit(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 0.01)
    rng = random.Random(4)
    line = " ".join(rng.choice("abcdefgh") for _ in range(14))
    rows = [(i, " ".join([*(str(rng.randrange(10**6)) for _ in range(25)), line, *(str(rng.randrange(10**6)) for _ in range(25))])) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len(substring_dedup.frequent_names(df.selectExpr("doc_id AS doc", "0L AS version", "cast(text AS binary) AS text"), len(rows)))
    assert {r.doc_id: tuple(r)[1:] for r in substring_dedup.deduplicated(df).collect()} == plain_dedup(rows)


def test_dedup_edge_cases(spark):
    schema = "doc_id long, text string"
    assert substring_dedup.deduplicated(spark.createDataFrame([], schema)).count() == 0
    w = [f"w{i}" for i in range(40)]
    text, other = " ".join(w), " ".join(w[10:])
    rows = [(None, text), (1, None), (2, "  "), (3, text), (3, text), (3, other), (4, "short text"), (5, "short text"), (6, "x" * 5000 + " " + text)]
    got = substring_dedup.deduplicated(spark.createDataFrame(rows, schema)).collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.n_words, r.n_removed))
    assert by_id[None] == [(40, 0)] and by_id[1] == by_id[2] == [(0, 0)]
    assert sorted(by_id[3]) == [(30, 30), (40, 40), (40, 40)]  # a null id comes first
    assert by_id[4] == by_id[5] == [(2, 0)] and by_id[6] == [(41, 40)]


def test_names_of_byte_strings():
    parts = [b"a", b"b", b"ab", b"abcdefgh", b"abcdefghi", b"x" * 300, b"x" * 301, b"\x00", b"\x00\x00"]
    data = np.frombuffer(b" ".join(parts) + hashing.PAD, np.uint8)
    begin, (one, two) = hashing.word_names(data, 2)
    assert len(begin) == len(parts) and len(set(one.tolist())) == len(set(two.tolist())) == len(parts) and not set(one.tolist()) & set(two.tolist())
    again = hashing.names(np.frombuffer(b"zz" + parts[4] + hashing.PAD, np.uint8), np.array([2]), np.array([9]))[0]
    assert again[0] == one[4]


# Alignment

ODD = [None, "", " ", "\n\n \n", "a", "A b", "<|endoftext|> x<|endoftext|>", "it's  we'll\t x 　", "▁▁ x▁ y", "ab" * 3000 + " " + "x" * 3000, "ﬁ ① 中文 é́ 😀", "a.b,c... d.,e .f", "\x02. x\x00\x1c y", "<s> </s> <0x0A>", " lead", "trail ", "  two  ", "a\n b \n c", "x\x85 y  z  w"]


def plain_alignment(rows):
    a, b = Tokenizer.from_file(queries.BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    a.encode_special_tokens = True
    of = byte_letters()
    a_bytes = {i: bytes(of[c] for c in s) for s, i in a.get_vocab(with_added_tokens=False).items() if all(c in of for c in s)}
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    per, counts = {}, collections.Counter()
    for doc, text in rows:
        per[doc] = None
        if not text:
            continue
        x, y, want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        if b"".join(a_bytes[i] for i in x) != want or b"".join(map(b_bytes, y)) != want:
            continue
        x_end, y_end = np.cumsum([len(a_bytes[i]) for i in x]).tolist(), np.cumsum([len(b_bytes(i)) for i in y]).tolist()
        pairs, i, j = [], 0, 0
        while i < len(x) and j < len(y):
            pairs.append((x[i], y[j]))
            both = x_end[i], y_end[j]
            i, j = i + (both[0] <= both[1]), j + (both[1] <= both[0])
        groups, common, j = [], set(x_end) & set(y_end), 0
        left, right = [], []
        for i, end in zip(x, x_end):
            left.append(i)
            if end in common:
                while not right or y_end[j - 1] != end:
                    right.append(y[j])
                    j += 1
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        per[doc] = (len(x), len(y), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest())
        counts.update(pairs)
    best = collections.Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return {d: (0, 0, 0, 0, 0, 0, "") if v is None else (*v[:3], len(v[3]), sum(counts[p] == best[p[1]] for p in v[3]), sum(counts[p] for p in v[3]), v[4]) for d, v in per.items()}


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(spark, monkeypatch, small):
    if small:  # blocks of few texts, and a memory that is full at once
        for name, value in (("BLOCK_BYTES", 500), ("STEP_BYTES", 200), ("MEMO", 50)):
            monkeypatch.setattr(alignment, name, value)
    rng = random.Random(5)
    alphabet = "ab. ,\n\t  éß中😀0019'<|>_ 　"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    given = [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 80").fetchall()]
    rows = list(enumerate(texts + given + given[:4]))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, pairs int").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.aligned(df, queries.BYTE_BPE, queries.PIECES).collect()}
    want = plain_alignment(rows)
    assert {d: v for d, v in got.items() if v != want[d]} == {} and len(got) == len(rows)


def test_shared_ends_by_division():
    rng = np.random.default_rng(6)
    for _ in range(50):
        parts = []
        a_end, b_end, at, first, last = [], [], 0, [], []
        for _ in range(rng.integers(1, 6)):
            size = int(rng.integers(1, 40))
            cuts = lambda: sorted({*rng.choice(np.arange(1, size + 1), rng.integers(1, size + 1)).tolist(), size})
            x, y = cuts(), cuts()
            first.append(len(a_end))
            a_end += [at + c for c in x]
            b_end += [at + c for c in y]
            last.append(len(a_end) - 1)
            at += size
            parts.append(set(x) & set(y))
        got = alignment.shared_ends(np.array(a_end), np.array(b_end), np.array(first), np.array(last))
        assert got.tolist() == [e in set(b_end) for e in a_end]


def test_alignment_of_nothing(spark):
    schema = "doc_id long, text string"
    assert alignment.aligned(spark.createDataFrame([], schema), queries.BYTE_BPE, queries.PIECES).count() == 0
    none = alignment.aligned(spark.createDataFrame([(1, None), (1, ""), (None, "▁")], schema), queries.BYTE_BPE, queries.PIECES).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.n_links, r.groups_sha256) for r in none) == [(0, 0, 0, ""), (1, 0, 0, ""), (1, 0, 0, "")]


# Personal data in several spellings

FORMS = {
    "phone": [["+1 415 555 0199", "+14155550199", "415-555-0199", "415.555.0199", "(415) 555-0199", "001 415 555 0199"], ["+44 20 7946 0958", "0044 20 7946 0958", "020 7946 0958", "+442079460958", "+44 (0)20 7946 0958"], ["+33 6 12 34 56 78", "06 12 34 56 78", "+33612345678"], ["+49 30 901820"], ["+358 9 1234567"]],
    "date": [["3.2.1990", "03.02.1990", "1990-02-03", "3/2/1990", "03/02/1990"], ["25.12.1990", "12/25/1990", "1990/12/25", "25/12/1990"]],
    "ip6": [["2001:db8::ff00:42:8329", "2001:0DB8:0:0:0:ff00:42:8329"]],
}


def test_spellings_of_one_value_stay_linked():
    from pickspark.llm import pii

    plain = {
        "phone": lambda s: re.sub(r"\D", "", s)[-9:].lstrip("0")[-9:],
        "date": lambda s: s,
        "ip6": lambda s: s,
    }
    for kind, groups in FORMS.items():
        for group in groups:
            made = []
            for text in group:
                new, spans = pii.replace(f"see {text}, please", b"key")
                assert [k for k, _, _ in spans] == [kind] and text not in new, text
                back, _ = pii.undone(new, spans, b"key")
                assert back == f"see {text}, please" or kind == "ip6", text
                made.append(new[spans[0][1] : spans[0][2]])
            if kind == "phone":
                assert len({plain[kind](m) for m in made}) == 1, made
            elif kind == "ip6":
                assert len(set(made)) == 1
    spelled = [pii.replace(t, b"key")[0] for t in FORMS["date"][0]]
    assert len({tuple(map(int, sorted(re.split(r"[./-]", t), key=int))) for t in spelled}) == 1


def test_what_looks_like_a_value_stays():
    from pickspark.llm import pii

    for text in ("::1", "12:30:45", "std::vector", "00:1B:44:11:3A:B7", "030 901820", "1/2", "32.13.1990", "03.2.1990", "+1 415 555 01", "version 1.2.3", "0 12 34"):
        assert pii.replace(text, b"key") == (text, []), text


def test_benchmark_with_text_ids(spark):
    from pickspark.llm import decontamination

    words = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "none of it"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("b-10", " ".join(words[3:15])), ("b-9", " ".join(words[10:24])), ("c", "absent " * 12), (None, " ".join(words))], "item_id string, text string")
    got = {r.doc_id: r for r in decontamination.documents_against_benchmark(docs, bench).collect()}
    assert (got[1].n_items, got[1].n_hit, got[1].items_sha256) == (2, 21, hashlib.sha256(b"b-10,b-9").hexdigest())
    assert not got[2].contaminated and got[3].n_words == 0


def test_empty_tables(spark):
    from pickspark.llm import bpe, decontamination, ngram_join, quality_rules, token_counts

    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert bpe.documents_round_trip(docs, queries.BYTE_BPE).count() == 0
    assert ngram_join.similarity_components(docs, 3, 90, 100).count() == 0 and ngram_join.one_of_each(docs).count() == 0
    assert token_counts.documents_token_counts(docs, queries.PIECES).count() == 0
    assert decontamination.documents_against_benchmark(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert quality_rules.documents_kept(docs, labels).count() == 0


def test_texts_longer_than_a_slab(spark, monkeypatch):
    from pickspark.llm import decontamination, grammar_files, ngram_join

    monkeypatch.setattr(ngram_join, "SLAB", 1 << 12)
    rng = random.Random(12)
    words = [f"{rng.randrange(10**7)}" for _ in range(4000)]
    other = list(words)
    other[2000] = "x" * 9000  # longer than two slabs
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[::-1])), (None, " ".join(words)), (4, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.similarity_components(df.where("doc_id IS NOT NULL"), 3, 90, 100).collect()}
    assert got == {(1, 3998): 1, (2, 3998): 1, (3, 3998): 3, (4, 3998): 1}
    assert ngram_join.similarity_components(df, 3, 90, 100).count() == len(rows)
    long = " ".join(words) * 40  # over a megabyte
    whole = Tokenizer.from_file(queries.BYTE_BPE).encode(long, add_special_tokens=False).ids
    assert grammar_files.LibraryEncoder(queries.BYTE_BPE).encode(long).tolist() == whole
    found = decontamination.documents_against_benchmark(spark.createDataFrame([(1, long * 7)], "doc_id long, text string"), spark.createDataFrame([(5, " ".join(words[1:13]))], "item_id long, text string")).first()
    assert found.n_hit == 12 * 280 and found.n_items == 1


def test_jump_hash_equals_a_scalar_loop(spark):
    from pickspark.llm import sharding

    def jump(key, buckets):
        b, j = -1, 0
        while j < buckets:
            b = j
            key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
            j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
        return b

    rng = random.Random(13)
    docs = spark.createDataFrame([(None if i == 7 else rng.randrange(-(1 << 62), 1 << 62), "same" if i % 3 else f"t{i}") for i in range(300)] + [(5, "a"), (5, "a")], "doc_id long, text string")
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    rows = sharding.documents_to_shards(docs).collect()
    assert len(rows) == 302
    for r in rows:
        if r.doc_id is None:  # rows without a key share a shard
            assert (r.shard, r.grown_shard) == (0, 0)
            continue
        assert (r.shard, r.grown_shard) == (jump(hashed[r.doc_id] & (1 << 64) - 1, 40), jump(hashed[r.doc_id] & (1 << 64) - 1, 41))
