"""Registered queries of the operators, and DuckDB SQL where SQL can express the whole result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff, bin_completion, crf_extract, decontaminate, exact, hard_negatives, langid, ngram_join, pack, prefix_trie, secret_scan, substring, warc
from .common import ship_package, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(substring.deduplicated(table(spark, sf_dir, "documents")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    result = langid.predicted(docs, langid.fit(docs.where(~held)))
    return result.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return crf_extract.extracted(pages, crf_extract.fit(pages))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scored(table(spark, sf_dir, "documents"))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.verdicts(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, seventh = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows, F.col("vec_id") % 50 == 0, label)


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_completion.packed(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_decontaminate, op2_pack, op3_ngram_join, op4_substring, op5_secrets, op6_warc, op7_langid, op8_html, op9_lm, op10_exact,
           op11_prefix_trie, op12_hard_negatives, op13_best_fit)
    return {f.__name__: _shipped(f) for f in own} | {"pipeline": _shipped(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    known = {"op10_exact": OP10, "op11_prefix_trie": OP11, "op12_hard_negatives": OP12, "op3_ngram_join": OP3, "op4_substring": OP4, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in known.items() if v}


OP10 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

OP3 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT r, CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, i, i + 3) END AS g
      FROM d, unnest(generate_series(1, greatest(1, len(w) - 3))) AS u(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n AS a ON a.r = x JOIN n AS b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach(x, y) AS (SELECT r, r FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
classes AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON d.r = y GROUP BY x),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, coalesce(degrees.n, 0)::BIGINT AS n_links
FROM d JOIN classes ON classes.x = d.r LEFT JOIN n ON n.r = d.r LEFT JOIN degrees ON degrees.x = d.r
"""

OP4 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM d, unnest(generate_series(1, len(w) - 12)) AS s(i) WHERE len(w) >= 13),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE doc_id > least),
words AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(generate_series(1, len(w))) AS s(i) WHERE len(w) > 0),
cut AS (SELECT DISTINCT doc_id, i + k AS i FROM gone, unnest(generate_series(0, 12)) AS s(k)),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS t, count(*) AS n
         FROM words ANTI JOIN cut ON words.doc_id = cut.doc_id AND words.i = cut.i GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

# the 32-bit checksum of decimal digits, bit by bit; a node's key is the list of its turns
OP11 = r"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                  {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x
           FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 20 AS source, list(x ORDER BY pos) AS own FROM t GROUP BY c),
h AS (SELECT c, source, own, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda k, i: xor(k >> 1, 3988292384 * (k & 1))))) % 4 AS h FROM convs),
r AS (SELECT h.c, list_concat(coalesce(list_slice(s.own, 1, h.h), []), list_slice(h.own, h.h + 1, len(h.own))) AS seq
      FROM h LEFT JOIN convs AS s ON s.c = h.source),
n AS (SELECT list_slice(seq, 1, d) AS k, d, min(c) AS conv_id, count(*) AS n_convs, list(c ORDER BY c) FILTER (len(seq) = d) AS ended
      FROM r, unnest(range(len(seq) + 1)) AS u(d) GROUP BY ALL),
kids AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
own AS (SELECT n.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE
               (n_convs - 1) * len(regexp_extract_all(n.k[d].text, '[^\x20\x09-\x0D]+')) END AS saved FROM n LEFT JOIN kids ON kids.k = n.k),
sums AS (SELECT list_slice(k, 1, u.d) AS k, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
         FROM own, unnest(range(own.d + 1)) AS u(d) GROUP BY ALL)
SELECT own.conv_id, own.d::BIGINT AS depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(array_to_string(own.ended, ','), '')) AS ends_sha256
FROM own JOIN sums ON sums.k = own.k LEFT JOIN n AS p ON own.d > 0 AND p.k = list_slice(own.k, 1, own.d - 1)
"""

OP12 = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM e AS a JOIN e ON e.vec_id <> a.vec_id AND len(e.v) = len(a.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
