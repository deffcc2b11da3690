import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pickspark.llm import decontamination, pii, toxicity
from pickspark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    documents = table(spark, SF, "documents")
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).checkpoint()
        if name == "toxicity":
            assert toxicity.judged(docs, table(spark, SF, "labels")).where("is_toxic").count() == counts[-1] - out.count()
        if name == "decontamination":
            assert decontamination.matches(out, table(spark, SF, "benchmark")).where("n_hit > 0").count() == 0
        if name == "pii":
            assert out.count() == counts[-1]
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.text == (pii.replace(texts[r.doc_id], corpus_pipeline.PII_KEY)[0] if texts[r.doc_id] else texts[r.doc_id]) for r in out.collect())
        if name != "bpe":
            assert out.columns == documents.columns
        docs = out
        counts.append(out.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[-1] > 0.5 * counts[0]
    assert docs.where(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_empty_and_null_documents(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0)], table(spark, SF, "documents").schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id, r.n_tokens) for r in docs.collect()) == [(1, 0), (2, 0)]


def test_a_run_goes_on_where_one_died(spark, tmp_path, monkeypatch):
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    seen, stages = [], corpus_pipeline.STAGES

    def counted(name, stage, dies):
        def f(*args):
            seen.append(name)
            if dies:
                raise RuntimeError("died")
            return stage(*args)

        return name, f

    monkeypatch.setattr(corpus_pipeline, "STAGES", [counted(n, f, n == "pii") for n, f in stages])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, SF, str(tmp_path / "run"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [counted(n, f, False) for n, f in stages])
    seen.clear()
    again = corpus_pipeline.run(spark, SF, str(tmp_path / "run"))
    assert seen == ["pii", "bpe"] and sorted(map(tuple, again.collect())) == whole
    assert [p.name for p in (tmp_path / "run").iterdir()] == ["bpe"]  # what was used up is gone


def test_the_key_is_the_callers(spark):
    docs = spark.createDataFrame([(1, "card 4111 1111 1111 1111")], "doc_id long, text string")
    a, b = (corpus_pipeline.hide_personal_data(spark, docs, SF, k).first().text for k in (b"one", b"two"))
    assert a != b and "4111" not in a + b
