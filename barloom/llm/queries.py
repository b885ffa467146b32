"""The registered queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.schema import configure

from . import (
    bpe_prefix,
    cross_polytope,
    huffman,
    langid,
    mixing,
    packing,
    pii,
    prefix_trie,
    ranked_search,
    rp_forest,
    secret_scan,
    simhash,
    toxicity,
)
from .common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
#: Folds that are never learned from: crc32(doc_id) modulo folds, and the one held out.
TOXIC_FOLDS = (5, 0)
LANGUAGE_FOLDS = (4, 2)


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_vectors(table(configure(spark), sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(configure(spark), sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_prefix.round_trip(table(configure(spark), sf_dir, "documents"), RANKS, PATTERN)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(configure(spark), sf_dir, "documents"), VOCABULARY, PATTERN)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(configure(spark), sf_dir, "embeddings")
    return cross_polytope.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(configure(spark), sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels, *TOXIC_FOLDS)
    return toxicity.score_toxicity(docs, model, *TOXIC_FOLDS)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return langid.identify(docs, langid.fit_languages(docs, *LANGUAGE_FOLDS), *LANGUAGE_FOLDS)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    files = huffman.write_token_files(docs, VOCABULARY, PATTERN)
    return huffman.read_token_files(spark, files, digests=True)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(configure(spark), sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(configure(spark), sf_dir, "documents"))


def op11_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(configure(spark), sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(configure(spark), sf_dir, name) for name in ("documents", "benchmark"))
    return ranked_search.search(docs, items)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(*prefix_trie.rebuilt(table(configure(spark), sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_vectors,
        op2_simhash,
        op3_bpe_round_trip,
        op4_best_fit_packing,
        op5_nearest,
        op6_toxicity,
        op7_language,
        op8_token_files,
        op9_personal_data,
        op10_secrets,
        op11_mixture,
        op12_ranked_search,
        op13_prefix_trie,
    )
}

#: What SQL can state on whole tables: links between vectors, the mixture, the ranking, the trie.
#: The others need a hash, a tokenizer or a fitted model that SQL does not have, or allow for misses.
ORACLE_SQL: dict[str, str] = {
    "op1_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a AS node, a AS other FROM pairs
  UNION SELECT r.node, p.b FROM reach AS r JOIN pairs AS p ON r.other = p.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY 1),
linked AS (SELECT a, count(*) AS n FROM pairs GROUP BY 1)
SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links,
       coalesce(m.component_id, e.vec_id) AS component_id,
       coalesce(m.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings AS e LEFT JOIN linked AS l ON e.vec_id = l.a
LEFT JOIN least AS m ON e.vec_id = m.node""",
    "op11_mixture": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('=' || source, '') AS k,
         md5(concat_ws('|', '42', coalesce(doc_id::VARCHAR, '-'), md5(coalesce(text, '')))) AS mark
  FROM documents),
s AS (SELECT k, source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM s),
w AS (SELECT *, [5, 2, 1][(i % 3 + 1)::INT] AS w, source_size * 2 AS cap FROM r),
o AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS asked,
    coalesce(sum(cap) OVER before, 0) AS cap_before,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_rest
  FROM w WINDOW before AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * w_rest <= (asked - cap_before::DOUBLE) * w AS is_full FROM o),
t AS (
  SELECT *, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (asked - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::DOUBLE)
    / (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())::DOUBLE * w END AS target,
    greatest(ceil(source_size / 1048576), ceil(n / 2048))::BIGINT AS shards
  FROM f),
p AS (
  SELECT d.*, t.source_size, t.target, ('0x' || substr(mark, 1, 12))::BIGINT % t.shards AS shard
  FROM d JOIN t USING (k)),
c AS (SELECT k, shard, sum(size)::BIGINT AS words, ceil(sum(size) / 16)::BIGINT AS blocks FROM p
      GROUP BY 1, 2 HAVING sum(size) > 0),
u AS (SELECT k, i, target / source_size * (sum(blocks))::DOUBLE AS v, sum(blocks)::BIGINT AS n
      FROM c JOIN t USING (k) GROUP BY k, i, target, source_size),
x AS (SELECT *, floor(v)::BIGINT AS s, round(sum(v::DECIMAL(30, 6)) OVER ())::BIGINT - sum(floor(v)::BIGINT) OVER () AS spare FROM u),
y AS (SELECT *, s + CASE WHEN v > s AND row_number() OVER (
        ORDER BY CASE WHEN v > s THEN v / (2 * s + 1) ELSE -1 END DESC, i) <= spare THEN 1 ELSE 0 END AS seats FROM x),
cv AS (SELECT c.*, y.seats, (y.seats * c.blocks) / y.n AS v FROM c JOIN y USING (k)),
cx AS (SELECT *, floor(v)::BIGINT AS s, seats - sum(floor(v)::BIGINT) OVER (PARTITION BY k) AS spare FROM cv),
q AS (
  SELECT k, shard, words, blocks, s + CASE WHEN v > s AND row_number() OVER (PARTITION BY k
      ORDER BY CASE WHEN v > s THEN v / (2 * s + 1) ELSE -1 END DESC, shard) <= spare THEN 1 ELSE 0 END AS quota,
    ('0x' || substr(md5(concat_ws('|', '42', k, shard::VARCHAR)), 1, 12))::BIGINT AS shift
  FROM cx),
a AS (
  SELECT p.*, q.words, q.blocks, q.quota::BIGINT AS quota, q.shift, coalesce(sum(size) OVER (PARTITION BY p.k, p.shard
      ORDER BY mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM p LEFT JOIN q ON p.k = q.k AND p.shard = q.shard)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE list_sum(list_transform(
    range(((pos + 1) * blocks - 1) // words, ((pos + size) * blocks - 1) // words + 1),
    lambda j: (least(((j + 1) * words) // blocks, pos + size) - greatest((j * words) // blocks, pos))
      * (quota // blocks + CASE WHEN (j * 2147483647 + shift) % blocks < quota % blocks THEN 1 ELSE 0 END)))
  END::BIGINT AS taken
FROM a""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
whole AS (SELECT count(*) FILTER (WHERE len(terms) > 0)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
tf AS (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM tf GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY 1),
i AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM i GROUP BY ALL),
s AS (
  SELECT q.item_id, p.r, p.doc_id, sum(q.times * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN p USING (term), whole GROUP BY 1, 2, 3),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10""",
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) % 9 AS h
  FROM t GROUP BY 1),
g AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS given FROM c LEFT JOIN c AS b ON c.base = b.conv_id),
r AS (
  SELECT g.conv_id, t.pos, t.turn FROM g JOIN t ON t.conv_id = g.base AND t.pos < g.h
  UNION ALL SELECT g.conv_id, t.pos - g.h + g.given, t.turn FROM g JOIN t ON t.conv_id = g.conv_id AND t.pos >= g.h),
s AS (SELECT conv_id, list(turn ORDER BY pos) AS turns FROM r GROUP BY 1),
w AS (SELECT c.conv_id, coalesce(s.turns, []) AS turns FROM c LEFT JOIN s USING (conv_id)),
m AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM w),
p AS (SELECT conv_id, n, depth, turns[1:depth] AS path FROM m),
v AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN depth > 0 THEN strlen(path[depth].text) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
k AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY 1, 2),
x AS (SELECT v.*, coalesce(k.n_children, 0) AS n_children FROM v LEFT JOIN k USING (path, depth)),
u AS (
  SELECT a.path, a.depth, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum(d.saved) AS saved_tokens
  FROM x AS a JOIN x AS d ON d.depth >= a.depth AND d.path[1:a.depth] = a.path GROUP BY 1, 2)
SELECT x.conv_id, x.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, x.n_convs, x.n_children, u.n_leaves,
  u.saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM x JOIN u USING (path, depth)
LEFT JOIN x AS parent ON parent.depth = x.depth - 1 AND parent.path = x.path[1:x.depth - 1]""",
}
