"""Registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontam, embed, kdshard, langid, license_scan, minhash, mix, pii, prefixtrie, secret_scan, stringkernel, substring, vectorcode
from cohortlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORDS = r"[^\x20\x09-\x0D]+"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.c >= 75 * (x.n + y.n - p.c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, other) AS (SELECT a, b FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, min(other) AS m FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce(c.m, d.doc_id))::BIGINT AS component_id,
  d.doc_id = least(d.doc_id, coalesce(c.m, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id
"""


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


SQL["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM r)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (
  SELECT x.doc_id, count(c.p) AS n_removed, string_agg(x.word, ' ' ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept
  FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshard.shard(table(spark, sf_dir, "documents"))


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op2_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(node, other) AS (SELECT a, b FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT node, min(other) AS m FROM r GROUP BY node),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id))::BIGINT AS component_id,
  e.vec_id = least(e.vec_id, coalesce(c.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN k ON k.a = e.vec_id LEFT JOIN c ON c.node = e.vec_id
"""


@query
def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcode.compress(table(spark, sf_dir, "embeddings")).drop("label")


def _vector_code_sql() -> str:
    """Plain k-means, one chain of common tables per round."""
    out = ["""
WITH k0 AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(4096 * x)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT greatest(1, (max(len(v)) + 7) // 8) AS w FROM k0),
pts AS MATERIALIZED (
  SELECT rid, vec_id, label, p, list_transform(range(1, w + 1), lambda i: coalesce(v[p * w + i], 0)) AS x
  FROM k0, w, range(8) t(p)),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, min(x) AS c FROM pts
  WHERE vec_id IN (SELECT DISTINCT vec_id FROM k0 WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT 16) GROUP BY p, vec_id)"""]
    near = """
{name} AS MATERIALIZED (
  SELECT pts.rid, pts.p, min((list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e)) AS m
  FROM pts JOIN c{k} c ON c.p = pts.p GROUP BY pts.rid, pts.p)"""
    for k in range(vectorcode.ROUNDS):
        out.append(near.format(name=f"a{k}", k=k))
        out.append(f"""
u{k} AS (
  SELECT p, e, list(v ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(s) - (((sum(s) % sum(n)) + sum(n)) % sum(n))) // sum(n) AS v FROM (
      SELECT a.p, a.m[2] AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS s, 1 AS n
      FROM a{k} a JOIN pts ON pts.rid = a.rid AND pts.p = a.p) GROUP BY p, e, i) GROUP BY p, e)""")
        out.append(f"""
c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(u.c, c.c)::BIGINT[] AS c FROM c{k} c LEFT JOIN u{k} u ON u.p = c.p AND u.e = c.e)""")
    last = vectorcode.ROUNDS
    out.append(near.format(name="f", k=last))
    out.append(f"""
h AS (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS s FROM c{last}),
r AS (
  SELECT k0.rid, k0.vec_id, k0.label, coalesce(string_agg(printf('%02x', f.m[2]::INTEGER), '' ORDER BY f.p), '') AS code,
    coalesce(sum(f.m[1]), 0)::BIGINT AS error
  FROM k0 LEFT JOIN f ON f.rid = k0.rid GROUP BY k0.rid, k0.vec_id, k0.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h.s AS codebooks_sha256 FROM r, h""")
    return ",".join(out)


SQL["op11_vector_codes"] = _vector_code_sql()


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


def _crc32_sql(expr: str) -> str:
    """Unsigned CRC-32 of a string's bytes, bit by bit (reversed polynomial)."""
    return f"""(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({expr}) + 1), lambda i: ascii(substr({expr}, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)))"""


SQL["op12_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
c AS (
  SELECT s.conv_id, s.own, xor({_crc32_sql("s.conv_id::VARCHAR")}, 4294967295::BIGINT) % 4 AS h,
    s.conv_id - s.conv_id % 20 AS base FROM s),
r AS (
  SELECT c.conv_id, t.pos AS o, t.role, t.text, 0 AS part FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, t.pos, t.role, t.text, 1 FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
q AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '{WORDS}')) AS tokens,
    list(sha256(concat(length(role), ':', role, text))) OVER (w ROWS UNBOUNDED PRECEDING) AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, o)),
p AS (
  SELECT conv_id, depth, tokens, md5(array_to_string(path, '')) AS node,
    CASE WHEN depth = 1 THEN 'root' ELSE md5(array_to_string(path[:depth - 1], '')) END AS parent FROM q
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM c),
l AS (SELECT conv_id, max(depth) AS n FROM p GROUP BY conv_id),
n AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(tokens) AS tokens,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE l.n = depth), '')) AS ends
  FROM p JOIN l ON l.conv_id = p.conv_id GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n FROM n WHERE parent IS NOT NULL GROUP BY parent),
u AS (
  SELECT a.node, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.tokens) AS saved
  FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth >= a.depth
  JOIN n d ON d.node = b.node AND d.conv_id = b.conv_id LEFT JOIN k ON k.node = d.node GROUP BY a.node)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, m.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n, 0)::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n LEFT JOIN n m ON m.node = n.parent LEFT JOIN k ON k.node = n.node JOIN u ON u.node = n.node
"""


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringkernel.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
