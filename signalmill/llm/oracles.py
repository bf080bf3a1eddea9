"""SQL twins of the registered operator queries, where SQL can express them."""

from __future__ import annotations

WORDS = r"coalesce(len(regexp_extract_all({}, '[^\x20\x09-\x0D]+')), 0)"

SOURCE_MIX = f"""
WITH d AS (
  SELECT doc_id, source, {WORDS.format("text")}::BIGINT AS size,
         md5('7|' || coalesce(doc_id::VARCHAR, md5(text), '')) AS mark
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s0),
s2 AS (SELECT *, [3, 1, 2][((place - 1) % 3 + 1)::INT] AS weight FROM s1),
s3 AS (
  SELECT *,
    (1.5::DOUBLE * (sum(source_size) OVER ()) - coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN
      UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND
      UNBOUNDED FOLLOWING) AS step
  FROM s2 WINDOW w AS (ORDER BY 2::DOUBLE * source_size / weight, place)),
s4 AS (
  SELECT source, source_size, place,
    least((2 * source_size)::DOUBLE, weight * (max(step) OVER ())) AS target FROM s3),
s5 AS (
  SELECT *, target / nullif(sum(target) OVER (), 0) AS part, count(*) OVER () AS n,
    round(sum(target) OVER () / 16)::BIGINT AS seats FROM s4),
s6 AS (
  SELECT *, greatest(0, floor(seats * part - part * n / 2 - 1))::BIGINT AS low,
    ceil(seats * part + part * n / 2 + 1)::BIGINT AS high FROM s5),
s7 AS (SELECT *, seats - sum(low) OVER () AS rest FROM s6),
s8 AS (
  SELECT *, target / (2 * seat + 1) AS quotient
  FROM (SELECT *, unnest(range(low, high + 1)) AS seat FROM s7)),
s9 AS (
  SELECT *, row_number() OVER (ORDER BY quotient DESC, source NULLS FIRST) <= rest AS won FROM s8),
quota AS (
  SELECT source, source_size, target, ceil(source_size / 524288)::BIGINT AS n_shards,
    low + sum(won::INT) AS quota
  FROM s9 GROUP BY source, source_size, target, low),
p AS (
  SELECT d.*, q.source_size, q.target, q.quota,
    ('0x' || left(d.mark, 8))::BIGINT % q.n_shards AS shard
  FROM d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source WHERE d.size > 0),
h0 AS (
  SELECT source, shard, sum(size) AS votes, max(quota) AS seats FROM p GROUP BY source, shard),
h1 AS (
  SELECT *, votes / sum(votes) OVER g AS part, count(*) OVER g AS n
  FROM h0 WINDOW g AS (PARTITION BY source)),
h2 AS (
  SELECT *, greatest(0, floor(seats * part - part * n / 2 - 1))::BIGINT AS low,
    ceil(seats * part + part * n / 2 + 1)::BIGINT AS high FROM h1),
h3 AS (SELECT *, seats - sum(low) OVER (PARTITION BY source) AS rest FROM h2),
h4 AS (
  SELECT *, votes / (2 * seat + 1) AS quotient
  FROM (SELECT *, unnest(range(low, high + 1)) AS seat FROM h3)),
h5 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) <= rest AS won
  FROM h4),
h6 AS (
  SELECT source, shard, votes AS shard_size, least((low + sum(won::INT)) * 16, 2 * votes) AS words
  FROM h5 GROUP BY source, shard, votes, low),
h7 AS (
  SELECT *, words // shard_size AS rounds, words % shard_size AS run,
    ('0x' || left(md5('7|' || coalesce(source, '') || '|' || shard), 8))::BIGINT
      % ceil(shard_size / 16)::BIGINT * 16 AS start
  FROM h6),
o AS (
  SELECT p.*, h.rounds, h.run, h.start, h.shard_size, sum(size) OVER (
    PARTITION BY p.source, p.shard ORDER BY mark, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop
  FROM p JOIN h7 h ON p.source IS NOT DISTINCT FROM h.source AND p.shard = h.shard)
SELECT doc_id, size, source_size, target,
  (rounds * size + greatest(0, least(stop, start + run) - greatest(stop - size, start))
   + greatest(0, least(stop, start + run - shard_size) - (stop - size)))::BIGINT AS taken
FROM o
UNION ALL
SELECT d.doc_id, d.size, q.source_size, q.target, 0::BIGINT
FROM d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source WHERE d.size = 0
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id, score
FROM s QUALIFY rank <= 20
"""

# crc32 of an integer's decimal text, which DuckDB has no function for.
CRC32 = """xor(4294967295, list_reduce(
    list_transform(range(1, len({0}::VARCHAR) + 1), lambda p: ascii(substr({0}::VARCHAR, p, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1
      THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)), 4294967295))"""


def _leaf_sql(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    texts = [f"({f})::VARCHAR" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {CRC32.format("doc_id")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} END AS forged,
    n_chars
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS row
  FROM d),
nodes AS (
  SELECT lang, 0 AS level, i, n, leaf AS h FROM r
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY level, i // 2, n),
walk AS (
  SELECT row, lang, 0 AS level, i, n,
    CASE WHEN forged IS NOT NULL AND n_chars IS NOT NULL THEN forged ELSE leaf END AS h,
    '' AS proof
  FROM r
  UNION ALL
  SELECT w.row, w.lang, w.level + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END),
    w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN nodes s
    ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.i = xor(w.i, 1)
  WHERE w.n > 1),
up AS (
  SELECT w.row, 0 AS level, s.i, s.n, w.h, w.proof
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.row, w.level + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END),
    w.proof || coalesce(s.h, '')
  FROM up w LEFT JOIN tops s ON s.level = w.level AND s.i = xor(w.i, 1)
  WHERE w.n > 1)
SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, sha256(u.proof) AS proof_sha256,
  u.h AS folded_root, u.h = t.h AS verified
FROM r JOIN up u ON r.row = u.row AND u.n = 1
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang
  JOIN tops t ON t.n = 1
"""

FILTER_AUDIT = f"""
WITH d0 AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words
  FROM documents),
d AS (
  SELECT part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * len(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) IS TRUE AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) IS TRUE AS toxic
  FROM d0),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good,
    count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
    unnest([1, 2, 3, 4, 5]) AS step,
    unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit,
    unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, 31 - e.bit]) AS ahead
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (bit | ahead) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & ahead <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS toxic_lost
  FROM c, o GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
  toxic_lost, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM r
"""

ORACLES: dict[str, str] = {
    "op4_threshold_top_k": TOP_K,
    "op5_source_mix": SOURCE_MIX,
    "op11_merkle_manifest": MERKLE,
    "op13_filter_audit": FILTER_AUDIT,
}
