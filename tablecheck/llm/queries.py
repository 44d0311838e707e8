"""The registered queries of this package, and what SQL can say about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import bpe, html_extract, jaccard_join, license_scan, packing, quality_classifier, quality_rules
from tablecheck.llm import ranked_search, secret_scan, spelling_variants, spotsigs, token_counts, toxicity, twins
from tablecheck.llm.common import table


def vocabulary(name: str) -> str:
    """Where this machine, and each executor, has the file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.against_neighbours(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = vocabulary("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), file), file)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), size=2048, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


RULE_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        *RULE_COLUMNS,
        quality_rules.base_failed().alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.Ledger(spark))
    base = [r.kind for r in secret_scan.BASE]
    of_kind = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *(F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in base),
        F.sha2(shown(of_kind(*base)), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP6_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT r, doc_id, text, len(ws)::bigint AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
  len(lines)::bigint AS n_lines, (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines FROM w),
p AS (SELECT r, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
t AS (SELECT r, i, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS n FROM t WHERE z IS NOT NULL),
k AS (SELECT r, count(DISTINCT i + j)::bigint AS n_repeat_words FROM c, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1 GROUP BY r),
a AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN k USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words * 3 OR (n_lines >= 4 AND n_dup_lines * 10 > n_lines * 3)
    OR word_chars < n_words * 2 OR word_chars > n_words * 15
    OR length(regexp_replace(text, '[^A-Z]', '', 'g')) * 2 > word_chars
    OR (length(text) - length(replace(text, '!!', ''))) * 5 > n_words * 2
    OR length(text) - length(replace(text, '...', '')) > n_words) AS kept
FROM b"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_ngram_jaccard_join,
        op3_bpe_round_trip,
        op4_token_counts,
        op5_packing,
        op6_quality_rules,
        op7_quality_classifier,
        op8_toxicity,
        op9_html_extraction,
        op10_secret_scans,
        op11_ranked_search,
        op12_license_scans,
        op13_spelling_variants,
        pipeline,
    )
}
ORACLES = {
    "op6_quality_rules": OP6_SQL,
    "op11_ranked_search": twins.OP11_SQL,
    "op12_license_scans": twins.OP12_SQL,
    "op13_spelling_variants": twins.OP13_SQL,
}
