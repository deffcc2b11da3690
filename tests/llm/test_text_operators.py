import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pickspark.llm import bpe, decontamination, grammar_files, ngram_join, pii, quality_rules, queries, sharding, token_counts, toxicity, url_templates
from pickspark.llm.components import connected_components

SF = "/root/testdata/sf0.001"
BYTE_BPE, PIECES = queries.BYTE_BPE, queries.PIECES
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\n \n", "a", "A b", "<|endoftext|> x<|endoftext|>", "it's  we'll\t x 　", "▁▁ x▁ y", "ab" * 3000 + " " + "x" * 3000, "ﬁ ① 中文 é́ 😀", "a.b,c... d.,e .f", "\x02. x\x00\x1c y", "<s> </s> <0x0A>"]


def documents(spark, texts, extra=True):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    # Columns with names that operators use themselves.
    return df.withColumns({"ids": F.lit("clash"), "n": F.lit(1), "component": F.lit("clash"), "hits": F.lit("clash")}) if extra else df


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def texts():
    con = duckdb.connect()
    given = [r[0] for r in con.execute(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 120").fetchall()]
    return ODD + given + given[:5] + ODD


@pytest.fixture(scope="module")
def ids(texts):
    t = Tokenizer.from_file(BYTE_BPE)
    return t, [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_bpe_equals_library(spark, texts, ids):
    t, want = ids
    got = {r.doc_id: r for r in bpe.documents_round_trip(documents(spark, texts), BYTE_BPE).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, w in enumerate(want):
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(w), sha(np.array(w, "<u4").tobytes())), texts[i]
        assert got[i].decoded_sha256 == sha(t.decode(w, skip_special_tokens=False).encode())
    again = bpe.decode(bpe.encode(documents(spark, texts), BYTE_BPE), BYTE_BPE)
    assert all((r.text or "") == r.decoded for r in again.collect())


def test_bpe_random_strings():
    rng = random.Random(1)
    c, t = bpe.Codec(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    alphabet = [*"ab's tTé ß\n\t\r  　\x1c\x85 12²Ⅷ一.,!?-_😀́'", "<|endoftext|>", "'ll", " the", "loooool"]
    for _ in range(1500):
        s = "".join(rng.choices(alphabet, k=rng.randint(0, 25)))
        assert np.frombuffer(c.encode(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_bpe_searches_new_words_together(monkeypatch):
    """New words are searched in step, few of them one by one, and a full table forgets none of the first third."""
    rng = random.Random(2)
    c, t = bpe.Codec(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    alone, ranks = [], c.ranks
    monkeypatch.setattr(c, "ranks", lambda text: alone.append(text) or ranks(text))
    monkeypatch.setattr(bpe, "MEMO", 9000)
    alphabet = [*"ab's tTé ß\n\t\r  　\x1c\x85 12²Ⅷ一.,!?-_😀́'", "<|endoftext|>", "'ll", " the", "loooool", "x" * 120]
    word = lambda: "".join(rng.choices("abcdeénorst", k=rng.randint(1, 12))) + rng.choice(["", "", ".", "***", ".\nThe", "é\x00"])
    c.encode("a frequent word")
    for _ in range(3):
        texts = [*(" ".join(["x", *(word() for _ in range(80)), "Ā" * 150]) for _ in range(100)), *("".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(200))]
        for text, own in zip(texts, c.encode_all(texts)):
            assert np.frombuffer(own, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
    assert len(alone) < 3 * 80 * 100 / 4 and "frequent" in c.spaced and len(c.spaced) < 16_000
    assert c.encode_all([]) == [] and c.searched(["a", "\n", " the"]) == [c.piece(x) for x in ("a", "\n", " the")]


def test_grammar_files(spark, texts, ids, tmp_path):
    start, want = 0, []
    for i, w in enumerate(ids[1]):
        own = np.array([*w, 0], "<u4")
        want.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    path = str(tmp_path / "ids")
    assert sorted(map(tuple, grammar_files.documents_through_files(documents(spark, texts), BYTE_BPE, path).collect())) == want
    flat = np.array([x for w in ids[1] for x in [*w, 0]])
    sizes = {r.shard: r.n for r in spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    base, shard = 0, min(sizes)
    for lo, hi in ((0, 1), (17, 900), (sizes[shard] - 5, sizes[shard])):
        assert grammar_files.read_range(spark, path, shard, lo, hi).tolist() == flat[base + lo : base + hi].tolist()


def test_repair_round_trip_and_gain():
    rng = np.random.default_rng(3)
    for seq in (np.zeros(5000, np.uint32), rng.integers(0, 50257, 3000).astype(np.uint32), np.tile(rng.integers(0, 50, 40), 400).astype(np.uint32), np.array([7], np.uint32)):
        rules, lengths, rest = grammar_files.compress(seq, 50257)
        block = grammar_files.Block(50257, rules.tobytes(), lengths.tobytes(), rest.tobytes())
        assert (block.read() == seq).all()
        for lo in (0, len(seq) // 3, len(seq) - 1):
            assert (block.read(lo, min(len(seq), lo + 100)) == seq[lo : lo + 100]).all()
    assert len(rest) == 1 and len(grammar_files.compress(np.zeros(5000, np.uint32), 50257)[2]) < 60


def test_library_encoder_random_strings(monkeypatch):
    monkeypatch.setattr(grammar_files, "MEMO", 300)
    monkeypatch.setattr(grammar_files, "LONGEST", 40)
    rng = random.Random(2)
    e, t = grammar_files.LibraryEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    alphabet = [*"ab's tTé ß\n\t\r  　\x1c\x85 12²Ⅷ一.,!?-_😀́'", "<|endoftext|>", "'ll", " the", "loooool", " ", " ", " x" * 5]
    for _ in range(150):
        some = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(10)]
        for s, got in zip(some, e.encode_all(some)):
            assert got.tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_words_are_asked_for_once_whatever_follows():
    e, t = grammar_files.LibraryEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    asked, ask = [], e.ask_all
    e.ask_all = lambda u, glued: asked.extend(u) or ask(u, glued)
    words = [f"stretch{chr(97 + i)}" for i in range(20)]
    texts = ["It said " + end.join(words) + end + "it's don't." for end in (" ", ", ", ". ", "! ", ".\nX ", "1 ", "; ", ") ", "%% ")]
    for s, got in zip(texts, e.encode_all(texts)):
        assert got.tolist() == t.encode(s, add_special_tokens=False).ids, s
    assert len(asked) < 3 * len(words)  # before: each word with what follows it


def thue_morse():
    """A word and its letter-swapped twin: every sum of powers of an odd base modulo 2**64 is the same for both."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_cancel_out_stay_apart(spark):
    x, y = thue_morse()
    texts = ["q " + x, "q " + y, "q " + x[:200], "q " + y[:200]]
    t = Tokenizer.from_file(BYTE_BPE)
    got = {r.doc_id: r for r in grammar_files.documents_through_files(documents(spark, texts), BYTE_BPE).collect()}
    for i, text in enumerate(texts):
        assert got[i].ids_crc32 == zlib.crc32(np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes())
    pair = documents(spark, texts[:2])
    assert [r.component_id for r in ngram_join.similarity_components(pair, 3, 90, 100).orderBy("doc_id").collect()] == [0, 1]
    assert ngram_join.one_of_each(pair).count() == 2


def test_stretches_of_one_name_are_told_apart(monkeypatch):
    """With names of two bits nearly all stretches share one; the second name sends their texts the slow way."""
    whole = grammar_files.names
    monkeypatch.setattr(grammar_files, "names", lambda *a: [whole(*a)[0] & np.uint64(3), whole(*a)[1]])
    e, t = grammar_files.LibraryEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(3)
    for _ in range(5):
        some = [" ".join(rng.choices(["the", "of", "walrus", "xyz", "12"], k=rng.randint(1, 9))) for _ in range(6)]
        for s, got in zip(some, e.encode_all(some)):
            assert got.tolist() == t.encode(s, add_special_tokens=False).ids


def test_repair_takes_the_more_frequent_of_overlapping_pairs():
    # b is left of c 90 times and right of a 40 times, 30 of them before a c.
    seq = [1, 2, 3] * 30 + [2, 3, 8] * 60 + [1, 2, 9] * 10
    seq = np.array([x for i, x in enumerate(seq) for x in ([x] if i % 3 < 2 else [x, 100 + i])], np.uint32)
    rules, lengths, rest = grammar_files.compress(seq, 50257)
    assert rules[0].tolist() == [2, 3]
    assert (grammar_files.Block(50257, rules.tobytes(), lengths.tobytes(), rest.tobytes()).read() == seq).all()
    # Nothing frequent is left.
    rng = np.random.default_rng(5)
    seq = rng.zipf(1.3, 60_000).astype(np.uint32) % 50_000
    rules, _, rest = grammar_files.compress(seq, 50257)
    pairs = collections.Counter(zip(rest[:-1].tolist(), rest[1:].tolist()))
    assert len(rules) and max(pairs.values()) < 2 * grammar_files.LEAST  # twice: a a a holds the pair a a twice, only one can go


def test_grammar_files_edge_cases(spark, tmp_path):
    empty = documents(spark, [], extra=False)
    assert grammar_files.documents_through_files(empty, BYTE_BPE, str(tmp_path / "none")).collect() == []
    rows = [(None, "a b"), (3, "x y z"), (3, None), (3, "x y z"), (1, "word " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "few")
    grammar_files.write(df, path, BYTE_BPE, block_tokens=16)
    t = Tokenizer.from_file(BYTE_BPE)
    size = lambda x: len(t.encode(x or "", add_special_tokens=False).ids) + 1
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in grammar_files.read(spark, path).collect())
    want, at = [], 0
    for d, x in [rows[0], rows[4], rows[2], rows[1], rows[3]]:
        want.append((at, d, size(x)))
        at += size(x)
    assert got == want


def test_token_counts_equal_library(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in token_counts.documents_token_counts(documents(spark, texts), PIECES).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), len(sp.encode(t or ""))), t


def brute_components(texts, k, num):
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()) for w in (words((t or "").translate(LOWER)) for t in texts)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80)])
def test_similarity_components_equal_brute_force(spark, k, num):
    rng = random.Random(k)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(n)] for n in (3, 9, 12, 30, 60, 200, 400)]
    texts = [None, "", "a", "a", "A b"]
    for w in base:
        for _ in range(12):
            v = list(w)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, len(v) // 40), max(1, len(v) // 25), max(1, len(v) // 12)])):
                v[rng.randrange(len(v))] = "new" + str(rng.randrange(1000))
            texts.append(" ".join(v[: rng.choice([len(v), len(v), len(v) - 1])]))
    got = ngram_join.similarity_components(documents(spark, texts), k, num, 100)
    assert sorted(map(tuple, got.collect())) == brute_components(texts, k, num)
    kept = ngram_join.one_of_each(documents(spark, texts), k, num, 100)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(texts, k, num)})


def test_components_of_a_chain(spark):
    chain = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a % 20 <> 19")
    got = {r.node: r.component for r in connected_components(chain).collect()}
    assert got == {i: i // 20 * 20 for i in range(60)}


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(6)
    text = lambda n: rng.choice([" ", "-", ", ", "\x00"]).join(rng.choices([*"abcd", "É", "Xy9"], k=n))
    items = [(i, text(rng.choice([0, 2, 5, 12, 30]))) for i in range(8)] + [(8, None), (9, "zz")]
    texts = [text(rng.randrange(0, 60)) + (" " + (rng.choice(items)[1] or "") if k % 3 else "") for k in range(60)] + [None, ""]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.documents_against_benchmark(documents(spark, texts), bench, 6).collect()}
    for i, t in enumerate(texts):
        w = split(t)
        hit, found = set(), set()
        for item, x in items:
            y = split(x)
            n = min(6, len(y))
            for p in range(len(w) - n + 1) if n else ():
                if any(w[p : p + n] == y[q : q + n] for q in range(len(y) - n + 1)):
                    hit |= set(range(p, p + n))
                    found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == (len(w), len(hit), len(found), sha, bool(hit))
    assert decontamination.clean(documents(spark, texts), bench.limit(0)).count() == len(texts)


def test_decontamination_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PASS_BYTES", 10)
    bench = spark.createDataFrame([(1, "a b c d"), (2, "e f g h"), (3, "c d e f")], "item_id long, text string")
    row = decontamination.matches(documents(spark, ["x a b c d e f g h"]), bench, 4).first()
    assert row.n_hit == 8 and sorted(m.item_id for m in row.matches) == [1, 2, 3]


def test_quality_statistics_equal_brute_force(spark, texts):
    got = {r.doc_id: r for r in quality_rules.judged(documents(spark, texts), []).collect()}
    for i, t in enumerate(texts):
        w, t = words(t), t or ""
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {p + d for p in range(len(w) - 2) if seen[tuple(w[p : p + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and r.kept == (not r.base_failed)


def test_quality_rules_hold_on_other_rows(spark):
    con = duckdb.connect()
    rows = con.execute("SELECT d.doc_id, text, quality FROM '/root/testdata/sf0.1/documents.parquet' d JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) WHERE d.doc_id % 3 = 0").fetchall()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2], "doc_id long, quality int")
    rules = quality_rules.learn(docs, labels)
    assert rules
    kept = {r.doc_id: r for r in quality_rules.judged(docs, rules).collect()}
    held = [(kept[d], q) for d, _, q in rows if d % 2 == 0]
    good = [k.kept for k, q in held if q == 1 and not k.base_failed]
    bad = [k.kept for k, q in held if q == 0 and not k.base_failed]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.5
    assert quality_rules.learn(docs, labels.limit(0)) == []


def test_quality_rules_leave_few_bad_rows(spark):
    con = duckdb.connect()
    rows = con.execute("SELECT d.doc_id, text, quality FROM '/root/testdata/sf0.1/documents.parquet' d JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) WHERE d.doc_id % 3 = 0").fetchall()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2], "doc_id long, quality int")
    kept = {r.doc_id: r for r in quality_rules.judged(docs, quality_rules.learn(docs, labels)).collect()}
    held = [(kept[d], q) for d, _, q in rows if d % 2 == 0 and not kept[d].base_failed]
    assert np.mean([k.kept for k, q in held if q == 1]) > 0.98 and np.mean([k.kept for k, q in held if q == 0]) < 0.1


def test_quality_rules_reject_rare_bad_rows(spark):
    # 2 % of the rows, in a small part of the range.
    texts = [" ".join(f"w{(i * 7 + j * 11) % 997}" for j in range(80)) + (" ##" if i % 50 == 0 else "") for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 50 > 0)) for i in range(2000)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.judged(docs, quality_rules.learn(docs, labels)).collect()}
    assert all(kept[i] == (i % 50 > 0) for i in range(2000))


def test_quality_rules_go_on_after_a_rule_that_is_not_kept():
    # The larger group is bad only where rules are grown, the smaller one everywhere.
    at = np.arange(3000)
    prune, a, b = at % 3 == 0, at < 600, at >= 2800
    rules = quality_rules.cover(b | a & ~prune, prune, {"words": a * 1.0, "dup_lines": b * 1.0})
    assert rules == [[quality_rules.Condition("dup_lines", True, 0.5)]]


def test_shards(spark, texts):
    rows = sharding.documents_to_shards(documents(spark, texts)).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)]
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    keys = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.bincount(sharding.jump(keys, 40), minlength=40)
    assert counts.min() > 4600 and counts.max() < 5400
    assert (sharding.jump(keys, 41) == 40).mean() == pytest.approx(1 / 41, rel=0.1)
    assert sharding.documents_to_shards(documents(spark, [])).count() == 0


PERSONAL = "mail jo.ann+x9@mail.example.com or +1 (415) 555-0199, card 4111 1111 1111 1111 on 2024-02-29 from 10.20.30.40 ssn 123-45-6789 iban GB82 WEST 1234 5698 7654 32 born 31.12.1999"
CLEAN = "Version 3.14 of 2024 had 4111111111111112 items, 999.1.1.1, 2024-13-40, 000-12-3456 and 1234567890123."


def test_pseudonyms(spark):
    out, spans = pii.replace(PERSONAL, b"k")
    assert [s[0] for s in spans] == ["email", "phone", "card", "date", "ip", "ssn", "iban", "date"]
    for value in ("jo.ann", "415", "4111", "2024-02-29", "10.20.30.40", "123-45-6789", "WEST 1234", "31.12.1999"):
        assert value not in out
    assert re.search(r"card \d{4} \d{4} \d{4} \d{4} on \d{4}-\d\d-\d\d from", out)
    assert pii.replace(out, b"k", back=True)[0] == PERSONAL and pii.replace(PERSONAL, b"j")[0] != out
    assert pii.replace(CLEAN, b"k") == (CLEAN, [])
    assert pii.replace("4111-1111-1111-1111", b"k")[0].replace("-", "") == pii.replace("4111111111111111", b"k")[0]
    df = documents(spark, [PERSONAL, None, "", PERSONAL, CLEAN])
    rows = {r.doc_id: r for r in pii.pseudonymise(df, b"k").collect()}
    assert rows[0].text == rows[3].text == out and rows[1].text is None and rows[2].text == "" and rows[4].pii == []
    assert [r.text for r in pii.restore(pii.pseudonymise(df, b"k"), b"k").orderBy("doc_id").collect()] == [PERSONAL, None, "", PERSONAL, CLEAN]


def test_toxicity_learns_from_labels_without_quality(spark):
    texts = [f"plain words of {'goodness' if i % 4 else 'vileness'} w{i % 9}" for i in range(200)]
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.is_toxic for r in toxicity.judged(documents(spark, texts), labels).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(200))


FOLLOWED = {
    "4111 1111 1111 1111 123": ("card", "4111 1111 1111 1111"),
    "4111111111111111 27 items": ("card", "4111111111111111"),
    "4111111111111111 12/28": ("card", "4111111111111111"),
    "3782-822463-10005 1234 x": ("card", "3782-822463-10005"),
    "12 34 4111 1111 1111 1111": ("card", "4111 1111 1111 1111"),
    "BE68 5390 0754 7034 BIC": ("iban", "BE68 5390 0754 7034"),
    "BE68539007547034 KREDBEBB": ("iban", "BE68539007547034"),
    "ES91 2100 0418 4502 0005 1332 EUR": ("iban", "ES91 2100 0418 4502 0005 1332"),
    "born 12/25/1990, at": ("date", "12/25/1990"),
    "born 25/12/1990, at": ("date", "25/12/1990"),
}


def test_values_followed_by_other_tokens(spark):
    for text, (kind, value) in FOLLOWED.items():
        out, spans = pii.replace(text, b"k")
        begin = text.index(value)
        assert spans == [(kind, begin, begin + len(value))], text
        assert out != text and (out[:begin], out[begin + len(value) :]) == (text[:begin], text[begin + len(value) :])
        assert pii.undone(out, spans, b"k") == (text, spans)
    # A chance sum over the digits that follow does not move a card's borders.
    for n in range(100):
        assert pii.replace(f"4111111111111111 {n:02d} items", b"k")[1] == [("card", 0, 16)]
    # Whatever day comes out, it is read month first again.
    days = [f"{m:02d}/{d}/1990" for m in range(1, 13) for d in range(13, 29)]
    out = [pii.replace(d, b"k")[0] for d in days]
    assert len(set(out)) == len(days) and [pii.replace(d, b"k", back=True)[0] for d in out] == days
    texts = [*FOLLOWED, *(f"card 4111 1111 1111 1111 {n:03d}." for n in range(100))]
    back = pii.restore(pii.pseudonymise(documents(spark, texts), b"k"), b"k").orderBy("doc_id").collect()
    assert [r.text for r in back] == texts


def test_planted_values_are_found_linked_and_restored(spark):
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))

    def value(kind):
        if kind == "card":
            d = rng.choice("45") + digits(14)
            d += str(pii.luhn(d))
            return rng.choice(["", " ", "-"]).join(d[i : i + 4] for i in (0, 4, 8, 12))
        if kind == "iban":
            body = digits(18)
            return "DE%02d" % (98 - int(body + "131400") % 97) + body
        if kind == "date":
            return rng.choice(["{0}-{1:02d}-{2:02d}", "{0}/{1:02d}/{2:02d}", "{2:02d}.{1:02d}.{0}", "{1:02d}/{2:02d}/{0}"]).format(rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(13, 28))
        if kind == "ip6":
            return ":".join("%x" % rng.randrange(1, 1 << 16) for _ in range(8))
        if kind == "ip":
            return ".".join(str(rng.randrange(256)) for _ in range(4))
        if kind == "phone":
            return rng.choice(["+1{0}", "+1 ({1}) 555-{2}", "{1}.555.{2}", "{1}-555-{2}", "({1}) 555-{2}"]).format(digits(10), digits(3), digits(4))
        if kind == "ssn":
            return f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
        return "".join(rng.choices("abcdefgXYZ019._", k=rng.randint(1, 90))) + "@mail.example.org"

    texts, places = [], []
    for _ in range(60):
        text, own = "", []
        for kind in rng.choices(list(pii.KINDS), k=5):
            v = value(kind)
            text += rng.choice(["see ", "of the ", "and, "])
            own.append((kind, len(text), len(text) + len(v)))
            text += v + rng.choice([" then ", ", ", " "])
        texts.append(text + "end")
        places.append(own)
    rows = pii.pseudonymise(documents(spark, texts), b"k").orderBy("doc_id").collect()
    to = {}
    for text, own, r in zip(texts, places, rows):
        assert [(s.kind, s.end - s.begin) for s in r.pii if s.kind[:2] != "ip"] == [(k, e - b) for k, b, e in own if k[:2] != "ip"] and len(r.pii) == len(own), text
        for (k, b, e), s in zip(own, r.pii):
            assert to.setdefault((k, text[b:e]), r.text[s.begin : s.end]) == r.text[s.begin : s.end]
    for kind in pii.KINDS:
        assert len({v for (k, _), v in to.items() if k == kind}) == sum(k == kind for k, _ in to)
    assert sum(a[1] == b for a, b in to.items()) <= 2
    assert [r.text for r in pii.restore(pii.pseudonymise(documents(spark, texts), b"k"), b"k").orderBy("doc_id").collect()] == texts
    # Every part of a long value changes, and cases of one mailbox stay linked.
    out = pii.replace("x" * 600 + "@a.org", b"k")[0]
    assert max(sum(c == "x" for c in out[i : i + 100]) for i in range(0, 600, 100)) < 25
    assert pii.replace("Jane.Doe@x.org", b"k")[0].lower() == pii.replace("jane.doe@X.org", b"k")[0].lower()
    assert pii.pseudonymise(documents(spark, []), b"k").count() == 0


def test_permutation_is_one_to_one():
    for size in (1, 2, 10, 97, 1000):
        to = [pii.permute(v, size, b"k", "t") for v in range(size)]
        assert sorted(to) == list(range(size))
        assert [pii.permute(v, size, b"k", "t", back=True) for v in to] == list(range(size))


def test_toxicity_on_held_out_rows(spark):
    con = duckdb.connect()
    rows = con.execute("SELECT d.doc_id, text, quality, toxic FROM '/root/testdata/sf0.1/documents.parquet' d JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id)").fetchall()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows if r[0] % 4], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.is_toxic for r in toxicity.judged(docs, labels).collect()}
    held = [(got[r[0]], r[3] == 1) for r in rows if r[0] % 4 == 0]
    assert np.mean([g for g, t in held if t]) > 0.9
    assert np.mean([g for g, t in held if not t]) < 0.01


def test_chain_equals_plain_chain():
    """The same models by plain loops over dense rows."""
    rng = np.random.default_rng(3)
    dense = rng.random((200, 12)) < 0.3
    y0 = (dense[:, 0] | dense[:, 1]).astype(float)
    y1 = (dense[:, 2] & (y0 > 0)).astype(float)
    y0[:5] = np.nan
    rows = [np.flatnonzero(r).tolist() for r in dense]
    chain = toxicity.train_chain(rows, np.column_stack([y0, y1]), ["a", "b"], {str(i): i for i in range(12)})
    fold = np.random.default_rng(7).permutation(200) % toxicity.FOLDS
    x, early = dense.astype(float), np.zeros((200, 0))
    for c, y in enumerate((y0, y1)):
        known = ~np.isnan(y)

        def plain(rows_):
            m, share = rows_.sum(), y[rows_].mean()
            w, e, b = np.zeros(12), np.zeros(early.shape[1]), np.log(share / (1 - share))
            vw, ve, vb = 0 * w, 0 * e, 0.0
            rate = 0.5 / np.sqrt(x[rows_].sum(0) / m + 1e-4)
            for _ in range(toxicity.STEPS):
                aw, ae, ab = w + 0.9 * vw, e + 0.9 * ve, b + 0.9 * vb
                g = (1 / (1 + np.exp(-(ab + x[rows_] @ aw + early[rows_] @ ae))) - y[rows_]) / m
                vw, ve, vb = 0.9 * vw - rate * (x[rows_].T @ g + toxicity.RIDGE * aw), 0.9 * ve - (early[rows_].T @ g + toxicity.RIDGE * ae), 0.9 * vb - g.sum()
                w, e, b = w + vw, e + ve, b + vb
            return w, e, b

        w, e, b = plain(known)
        assert np.allclose(chain.models[c].weights, w) and np.allclose(chain.models[c].earlier, e) and np.isclose(chain.models[c].bias, b)
        held = np.zeros(200)
        for k in range(toxicity.FOLDS):
            w, e, b = plain(known & (fold != k))
            held = np.where(fold == k, 1 / (1 + np.exp(-(b + x @ w + early @ e))), held)
        early = np.column_stack([early, held])
    p = early[:, 1]
    f1 = lambda t: 2 * (y1 * (p >= t)).sum() / ((p >= t).sum() + y1.sum())
    assert f1(chain.thresholds[1]) == pytest.approx(max(f1(t) for t in p))
    assert toxicity.best_threshold(np.array([0.1, 0.2]), np.zeros(2)) > 1 and toxicity.best_threshold(np.array([0.1, 0.2, 0.9]), np.array([0, 0, 1.0])) == pytest.approx(0.6, abs=0.01)


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.judged(documents(spark, ["you idiot", None, ""]), labels).collect()
    assert [r.is_toxic for r in rows] == [False] * 3
    assert toxicity.judged(documents(spark, []), labels).count() == 0


URLS = ["http://a.example.net/en/1", "https://b.example.net/de/1", "http://example.com/de/1?x", "http://x.Example.ORG/fr/2#y", "http://notexample.com/de/1", None, "no scheme", "http://h.org", "http://q.org/a/b/c/d/e/f/g/h/i", "http://h.org?x=://y/z", "http://net/x"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_templates.judged(pages, none, url_templates.RULES).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("b.example.net", "/de/1", "net/", "block")
    assert got[2] == ("example.com", "/de/1", "example.com/de/", "block")
    assert got[3] == ("x.example.org", "/fr/2", "org/fr/", "allow")
    assert got[4] == ("notexample.com", "/de/1", None, "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7][:2] == ("h.org", "") and got[9][:2] == ("h.org", "") and got[10] == ("net", "/x", "net/", "block")
    assert got[8] == ("q.org", "/a/b/c/d/e/f/g/h/i", None, "allow")


def test_url_templates_do_not_merge_graded_siblings(spark):
    rows = [("h", f"/s{i:02d}/*.html", 200, round(200 * i / 39)) for i in range(40)]
    shares = {r.template: r.bad_share for r in url_templates.purity(spark.createDataFrame(rows, "host string, template string, n long, k long")).collect()}
    assert len(shares) == 40
    for i in range(40):
        # Near its own share: 0.15 is some four standard errors of 200 pages.
        assert abs(shares[f"/s{i:02d}/*.html"] - i / 39) < 0.15


def test_url_templates_reject_what_is_mostly_bad(spark):
    rows = [(i, f"http://h.org/{'spam' if i % 2 else 'news'}/{i}.html") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    bad = spark.createDataFrame([(i, i % 2) for i in range(0, 400, 3)], "page_id long, bad int")
    got = url_templates.judged(pages, bad, {}).collect()
    assert {r.template for r in got} == {"/spam/*.html", "/news/*.html"}
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) for r in got)


def plain_templates(pages):
    """Templates and smoothed shares of (host, path, bad) rows, by recursion over a tree in memory."""
    rare, few, errors, weight, reject = url_templates.RARE, url_templates.FEW, url_templates.ERRORS, url_templates.WEIGHT, url_templates.REJECT
    wild = lambda p: "" if p == "" else "*" + (re.search(r"(\.[A-Za-z]{1,5})?$", p)[0])
    template = {}
    for host in {h for h, _, _ in pages}:
        ways = [(p, p[1:].split("/") if p else []) for h, p, _ in pages if h == host]

        def grow(rows, level, so_far):
            for p, w in rows:
                if len(w) == level:
                    template[host, p] = so_far
            rows = [(p, w) for p, w in rows if len(w) > level]
            n = collections.Counter(w[level] for _, w in rows)
            often = {v for v, c in n.items() if c >= max(rare * len(rows), few)}
            by = collections.defaultdict(list)
            for p, w in rows:
                by[w[level] if w[level] in often else wild(w[level])].append((p, w))
            for v, part in by.items():
                grow(part, level + 1, f"{so_far}/{v}")

        grow(ways, 0, "")
    leaf = collections.defaultdict(lambda: [0, 0])
    for h, p, bad in pages:
        if bad is not None:
            leaf[h, template[h, p]][0] += 1
            leaf[h, template[h, p]][1] += bad
        leaf[h, template[h, p]]
    prior = sum(k for _, k in leaf.values()) / max(1, sum(n for n, _ in leaf.values()))
    smooth = lambda n, k, p: (k + p * weight) / (n + weight)
    out = {}
    for host in {h for h, _ in leaf}:
        ways = {t: t.split("/") for h, t in leaf if h == host}
        below = dict.fromkeys(ways, False)
        for level in range(max(map(len, ways.values())) - 1, 0, -1):
            places = collections.defaultdict(lambda: collections.defaultdict(list))
            for t, w in ways.items():
                if len(w) > level:
                    ending = (re.search(r"\.[A-Za-z]{1,5}$", w[level]) or [""])[0]
                    places[tuple(w[:level]), ending][w[level]].append(t)
            renames = {}
            for branches in places.values():
                stat = {v: (sum(leaf[host, t][0] for t in ts), sum(leaf[host, t][1] for t in ts), {ways[t][level + 1]: below[t] for t in ts if len(ways[t]) > level + 1}) for v, ts in branches.items()}
                groups = []
                for v in sorted(branches, key=lambda v: (smooth(*stat[v][:2], prior), v)):
                    n, k, subs = stat[v]
                    g = groups[-1] if groups else None
                    if g and url_templates.apart(n, k, g[1], g[2]) <= errors and all(g[3].get(x, b) == b for x, b in subs.items()):
                        g[0].append(v)
                        g[1], g[2] = g[1] + n, g[2] + k
                        g[3].update(subs)
                    else:
                        groups.append([[v], n, k, dict(subs)])
                for vs, n, k, _ in groups:
                    for v in vs:
                        for t in branches[v]:
                            renames[t] = (min(vs), smooth(n, k, prior) >= reject)
            below = dict.fromkeys(ways, False)
            for t, (name, bad) in renames.items():
                ways[t] = [*ways[t][:level], name, *ways[t][level + 1 :]]
                below[t] = bad
        own = smooth(sum(n for (h, _), (n, _) in leaf.items() if h == host), sum(k for (h, _), (_, k) in leaf.items() if h == host), prior)
        for t, w in ways.items():
            same = [leaf[host, x] for x, y in ways.items() if y == w]
            out[host, t] = smooth(sum(n for n, _ in same), sum(k for _, k in same), own)
    return {(h, p): (template[h, p], out[h, template[h, p]]) for h, p, _ in pages}


def test_url_templates_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        host = rng.choice(["a.org", "a.org", "b.net", "c.d.com"])
        way = [rng.choice(["news", "blog", "spam", "shop", f"v{rng.randrange(300)}"]) for _ in range(rng.choice([0, 1, 2, 2, 3, 4]))]
        path = "".join("/" + w for w in way) + (f"/{rng.randrange(200)}{rng.choice(['', '.html', '.php'])}" if rng.random() < 0.8 else "")
        bad = None if rng.random() < 0.3 else int(rng.random() < (0.9 if "spam" in way else 0.6 if "shop" in way else 0.05))
        rows.append((host, path, bad))
    pages = spark.createDataFrame([(i, f"http://{h}{p}?q") for i, (h, p, _) in enumerate(rows)], "page_id long, url string")
    bad = spark.createDataFrame([(i, b) for i, (_, _, b) in enumerate(rows) if b is not None], "page_id long, bad int")
    want = plain_templates(rows)
    got = {r.page_id: r for r in url_templates.judged(pages, bad, {}).collect()}
    assert len(got) == len(rows)
    for i, (h, p, _) in enumerate(rows):
        template, share = want[h, p]
        assert (got[i].template, got[i].bad_share, got[i].verdict) == (template, pytest.approx(share), "block" if share >= 0.5 else "allow")
    assert 0 < sum(r.verdict == "block" for r in got.values()) < len(rows) // 2
    assert len({(r.host, r.merged) for r in got.values()}) < len({(r.host, r.template) for r in got.values()})


def test_url_templates_edge_cases(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    assert url_templates.judged(spark.createDataFrame([], "page_id long, url string"), none, url_templates.RULES).collect() == []
    long = "http://h.org/" + "/".join("x" * 50 for _ in range(40))
    rows = [(None, "http://h.org/a"), (1, "http://h.org/a"), (1, "http://h.org/a"), (2, long), (3, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "bad": F.lit(2), "template": F.lit("t")})
    got = url_templates.judged(pages, none, url_templates.RULES).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "allow"), (1, "allow"), (1, "allow"), (2, "allow"), (3, "allow")]


def test_url_templates_of_deep_paths(spark):
    deep = "/a/b/c/d/e/f/g"
    rows = [(i, f"http://h.org{deep}/{'spam' if i % 2 else 'news'}/{i}.html") for i in range(400)]
    rows += [(1000 + i, f"http://h.org/short/{i}") for i in range(20)] + [(2000, f"http://h.org{deep}/x/y//z/w.html"), (2001, "http://h.org")]
    bad = spark.createDataFrame([(i, i % 2) for i in range(0, 400, 3)], "page_id long, bad int")
    got = {r.page_id: r for r in url_templates.judged(spark.createDataFrame(rows, "page_id long, url string"), bad, {}).collect()}
    assert len(got) == len(rows)
    assert all((got[i].template, got[i].verdict) == ((f"{deep}/spam/*.html", "block") if i % 2 else (f"{deep}/news/*.html", "allow")) for i in range(400))
    assert {got[1000 + i].template for i in range(20)} == {"/short/*"}
    assert (got[2000].template, got[2001].template) == (f"{deep}/*/*//*/*.html", "")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = df.collect()
    assert got
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        found = con.execute(queries.ORACLES[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(found.fetchall())
