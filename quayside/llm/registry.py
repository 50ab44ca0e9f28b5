"""The subpackage's queries: the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import ann, bpe, divergence, exact, htmltext, mixing, neardup, pii, quality, sharding, substring, urlfilter, whitening
from quayside.llm.common import documents, prepare

TOKENIZER = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return documents(spark, sf_dir) if table == "documents" else spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_read(spark, sf_dir, "embeddings"), k=5)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_read(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=16)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents"), mixing.MIX_WEIGHTS)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_read(spark, sf_dir, "documents"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), shingle_size=4, threshold=(80, 100))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.filter_captures(urlfilter.page_captures(pages), urlfilter.page_entries(pages), urlfilter.HORIZON)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_read(spark, sf_dir, "documents"), window=50).drop("kept_text")


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_read(spark, sf_dir, "documents"))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(_read(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_read(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-length(text), doc_id)) AS keep_id FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""

SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h FROM d, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS pos) p WHERE len(w) >= 50),
low AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, list(DISTINCT pos + o) AS places FROM win JOIN low USING (h), LATERAL (SELECT unnest(range(0, 50)) AS o) q WHERE low < doc_id GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ') ELSE coalesce((
    SELECT string_agg(w[i], ' ' ORDER BY i) FROM (SELECT unnest(range(1, len(w) + 1)) AS i) x WHERE NOT list_contains(places, i)), '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


NEARDUP_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END, ' ')) AS g
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i) p WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS low FROM documents
  UNION
  SELECT b, low FROM reach JOIN ways ON a = doc_id WHERE low < b),
least AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN n USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_ann, op2_bpe, op3_sharding, op4_mixing, op5_pii, op6_neardup, op7_urlfilter, op8_quality, op9_substring, op10_exact,
        op11_html, op12_whitening, op13_divergence,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_sharding": sharding.SHARD_SQL,
        "op4_mixing": mixing.MIX_SQL,
        "op6_neardup": NEARDUP_SQL,
        "op7_urlfilter": urlfilter.URL_SQL,
        "op9_substring": SUBSTRING_SQL,
        "op10_exact": EXACT_SQL,
        "op11_html": htmltext.PAGES_SQL,
        "op13_divergence": divergence.DIVERGENCE_SQL,
    }
