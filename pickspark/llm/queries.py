"""The subpackage's registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, decontamination, grammar_files, ngram_join, pii, quality_rules, sharding, substring_dedup, token_counts, toxicity, url_templates, whitening
from .common import ship_package, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: The key of the pseudonyms in these queries; a deployment passes its own secret.
PII_KEY = b"registered query"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.documents_round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op2_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_files.documents_through_files(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "p_low_quality", "p_toxic", "is_toxic")


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.documents_token_counts(table(spark, sf_dir, "documents"), PIECES)


@query
def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.pages_judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return found.select("doc_id", F.size("pii").alias("n_pii"), "text")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.documents_against_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.documents_kept(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents_to_shards(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_ngram_join": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2])) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2, 3, 4),
l AS (SELECT a, b FROM p WHERE 100 * i >= 90 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT node, min(c) AS c FROM r GROUP BY 1) m ON m.node = s.doc_id""",
    "op8_decontamination": rf"""WITH dw AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
il AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM iw WHERE len(ws) > 0),
ig AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g FROM il),
dg AS (SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS pos, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g FROM dw JOIN (SELECT DISTINCT k FROM il) ks ON len(ws) >= k),
h AS (SELECT doc_id, item_id, pos, k FROM dg JOIN ig USING (k, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM h) x GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) x GROUP BY 1)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op12_substring_dedup": r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS pos, unnest(list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i:i + 19], ' '))) AS g FROM w WHERE len(ws) >= 20),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS nth FROM g),
x AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM r WHERE nth > 1),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM w),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM t ANTI JOIN x USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)""",
}
