"""The numbered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as P
from pyspark.sql import DataFrame, SparkSession

from hiremart.llm import bpe, common, decontaminate, html_text, language, merkle, ngram_join, periodic_runs, quality_rules, suffix_dedup, token_shards, toxicity, vector_search, warc


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.work_dir(spark, "op1-token-shards")
    token_shards.write_shards(_t(spark, sf_dir, "documents"), path, P.path("byte_bpe_50k.json"))
    return token_shards.read_digests(spark, path)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_t(spark, sf_dir, "documents"))


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(_t(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_t(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(_t(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(_t(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_t(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(_t(spark, sf_dir, "pages"), common.work_dir(spark, "op9-warc"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(_t(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_t(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_digest(_t(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_shards, op2_ngram_jaccard, op3_vector_search, op4_decontaminate, op5_suffix_dedup, op6_bpe, op7_language,
        op8_html_text, op9_warc, op10_toxicity, op11_merkle_manifest, op12_quality_rules, op13_periodic_runs,
    )}


_OP4_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_OP4_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_OP4_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g
       FROM (SELECT item, w, least(13, len(w)) AS l, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce({_OP4_WORDS.format("text")}, []) AS w FROM documents),
g AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g
      FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
            FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
h AS (SELECT DISTINCT doc_id, i, l, item FROM g JOIN bw USING (l, g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       (coalesce(hw.n, 0) > 0 AND coalesce(hw.n, 0) * 20 >= len(w)) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""


_OP9_SQL = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to, true AS has_request, true AS has_metadata
FROM k
"""


_OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc FROM documents),
f AS (SELECT doc_id, source, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
             coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head, text,
             CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS size,
                  dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree
           FROM (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS changed FROM f)),
low AS (SELECT tree, place, size, leaf AS digest, 0 AS h FROM leaves UNION ALL
        SELECT tree, place // 3, (max(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)), h + 1 FROM low WHERE size > 1 GROUP BY tree, place // 3, h),
subroots AS (SELECT tree, digest, h FROM low WHERE size = 1),
high AS (SELECT tree AS place, count(*) OVER () AS size, digest, 0 AS h FROM subroots UNION ALL
         SELECT place // 3, (max(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)), h + 1 FROM high WHERE size > 1 GROUP BY place // 3, h),
sib AS (SELECT *, coalesce(lag(digest, 2) OVER w, '') || coalesce(lag(digest) OVER w, '') AS before, coalesce(lead(digest) OVER w, '') || coalesce(lead(digest, 2) OVER w, '') AS after
        FROM (SELECT tree, place, digest, h FROM low WHERE size > 1 UNION ALL SELECT -1, place, digest, h FROM high WHERE size > 1)
        WINDOW w AS (PARTITION BY tree, h, place // 3 ORDER BY place)),
walk AS (SELECT doc_id, leaf, tree AS own, tree, place, 0 AS h, changed AS folded, '' AS proof FROM leaves UNION ALL
         SELECT k.doc_id, k.leaf, k.own, n.tree, n.place, n.h, n.folded, n.proof FROM (
           SELECT w.doc_id, w.leaf, w.own, w.tree, w.place, w.h, w.folded, w.proof, s.before, s.after FROM walk w LEFT JOIN sib s ON s.tree = w.tree AND s.place = w.place AND s.h = w.h) AS k,
         LATERAL (SELECT CASE WHEN k.before IS NULL THEN -1 ELSE k.tree END AS tree, CASE WHEN k.before IS NULL THEN k.own ELSE k.place // 3 END AS place, CASE WHEN k.before IS NULL THEN 0 ELSE k.h + 1 END AS h,
                         CASE WHEN k.before IS NULL THEN k.folded ELSE sha256(k.before || k.folded || k.after) END AS folded, k.proof || coalesce(k.before || k.after, '') AS proof) AS n
         WHERE k.before IS NOT NULL OR k.tree >= 0),
root AS (SELECT digest FROM high WHERE size = 1)
SELECT w.doc_id, w.leaf, s.digest AS subroot, root.digest AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = root.digest AS verified
FROM walk w JOIN subroots s ON s.tree = w.own, root WHERE w.tree = -1 AND NOT EXISTS (SELECT 1 FROM sib WHERE sib.tree = -1 AND sib.place = w.place AND sib.h = w.h)
"""

_OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '-') AS lk, coalesce('=' || source, '-') AS sk,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1) GROUP BY r),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
c AS (SELECT doc_id, lk, sk, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN l USING (r) LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 1000 * word_chars // n_words AS word_length, 1000 * n_symbols // n_words AS symbols,
             1000 * n_dup_lines // n_lines AS dup_lines, 1000 * n_repeat_words // n_words AS repeats FROM c),
v AS (SELECT lk, sk, ratio, least, v FROM (SELECT lk, sk, unnest([{'ratio': 'word_length', 'v': word_length, 'least': 500}, {'ratio': 'symbols', 'v': symbols, 'least': 50},
             {'ratio': 'dup_lines', 'v': dup_lines, 'least': 150}, {'ratio': 'repeats', 'v': repeats, 'least': 60}], recursive := true) FROM b WHERE NOT base_failed)),
s AS (SELECT lk, sk, ratio, least, (v >> h) << h AS bin, count(*) AS n FROM (SELECT *, greatest(length(bin(v)) - 6, 0) AS h FROM v)
      GROUP BY GROUPING SETS ((lk, sk, ratio, least, bin), (lk, ratio, least, bin), (ratio, least, bin))),
q AS (SELECT lk, sk, ratio, least, min(bin) FILTER (4 * u >= a) AS low, min(bin) FILTER (4 * u >= 3 * a) AS high, max(a) AS n
      FROM (SELECT *, sum(n) OVER (PARTITION BY lk, sk, ratio ORDER BY bin) AS u, sum(n) OVER (PARTITION BY lk, sk, ratio) AS a FROM s) GROUP BY ALL),
f AS (SELECT lk, sk, max(n) AS n, max(high + 3 * greatest(high - low, least)) FILTER (ratio = 'word_length') AS w1, max(low - 3 * greatest(high - low, least)) FILTER (ratio = 'word_length') AS w0,
             max(high + 3 * greatest(high - low, least)) FILTER (ratio = 'symbols') AS s1, max(high + 3 * greatest(high - low, least)) FILTER (ratio = 'dup_lines') AS d1,
             max(high + 3 * greatest(high - low, least)) FILTER (ratio = 'repeats') AS r1 FROM q GROUP BY lk, sk),
t AS (SELECT o.lk, o.sk, f.* EXCLUDE (lk, sk, n) FROM f AS o JOIN f ON (f.lk = o.lk AND f.sk = o.sk OR f.lk = o.lk AND f.sk IS NULL OR f.lk IS NULL)
      WHERE o.sk IS NOT NULL AND (f.n >= 50 OR f.lk IS NULL)
      QUALIFY row_number() OVER (PARTITION BY o.lk, o.sk ORDER BY f.lk IS NULL, f.sk IS NULL) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_length BETWEEN w0 AND w1 AND symbols <= s1 AND dup_lines <= d1 AND repeats <= r1, false) AS kept, n_lines
FROM b LEFT JOIN t USING (lk, sk)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": _OP4_SQL, "op9_warc": _OP9_SQL, "op11_merkle_manifest": _OP11_SQL, "op12_quality_rules": _OP12_SQL}
