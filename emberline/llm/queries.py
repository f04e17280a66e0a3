"""One query per operator over its whole table."""

from __future__ import annotations

from . import (html_text, language_mixture, line_dedup, lm_scoring, mixing, multiset_hash, near_dedup, packing, prefix_trie, quality_classifier, quality_rules,
               substring_dedup, vector_codes)
from .registry import ORACLE, QUERIES, query, table


__all__ = ["ORACLE", "QUERIES"]


@query("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    return quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("op2_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 33)) AS pos, words FROM w
), hashed AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 34], ' ') AS window_text FROM starts
), dup AS (
  SELECT doc_id, pos FROM hashed QUALIFY count(*) OVER (PARTITION BY window_text) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS i FROM dup
), per_word AS (
  SELECT u.doc_id, u.i, u.word, g.i IS NOT NULL AS removed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) u
  LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.i = u.i
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(x.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(x.kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
  FROM per_word GROUP BY doc_id) x USING (doc_id)
""")
def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], with_text=False)


@query("op4_minhash_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3
           THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.a AND l.b > r.root
)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM documents d LEFT JOIN size z USING (doc_id) JOIN (SELECT a, min(root) AS root FROM reach GROUP BY a) m ON m.a = d.doc_id
""")
def op4_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_source_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS cap FROM s
), rounds AS (
  SELECT 0 AS i, 0.0::DOUBLE AS share, (SELECT sum(source_size)::DOUBLE / sum(weight)::DOUBLE FROM w) AS next
  UNION ALL
  SELECT i + 1, next, (SELECT (sum(source_size) - coalesce(sum(cap) FILTER (weight * r.next > cap), 0))::DOUBLE
                              / (sum(weight) FILTER (weight * r.next <= cap))::DOUBLE FROM w)
  FROM rounds r WHERE share <> next
), t AS (
  SELECT *, CASE WHEN weight * (SELECT next FROM rounds ORDER BY i DESC LIMIT 1) > cap THEN cap::DOUBLE
                 ELSE weight * (SELECT next FROM rounds ORDER BY i DESC LIMIT 1) END AS target FROM w
), house AS (
  SELECT round(sum(target) / 64)::BIGINT AS seats FROM t
), seats AS (
  SELECT rank, count(*) AS blocks FROM (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS place
    FROM (SELECT rank, target, unnest(range(0, (target / 64)::BIGINT + 2 * (SELECT count(*) FROM t) + 2)) AS k FROM t WHERE target > 0))
  WHERE place <= (SELECT seats FROM house) GROUP BY rank
), dealt AS (
  SELECT d.*, t.source_size, t.target, t.rank, coalesce(b.blocks, 0) AS blocks,
         ('0x' || substr(md5(concat(doc_id, '|', 'mix-1')), 1, 8))::BIGINT % ceil((t.source_size + 1) / 262144)::BIGINT AS shard
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats b USING (rank)
), shards AS (
  SELECT rank, shard, sum(size)::BIGINT AS z, any_value(blocks) AS blocks FROM dealt GROUP BY rank, shard
), quotas AS (
  SELECT s.rank, s.shard, s.z, count(q.rank) AS quota FROM shards s LEFT JOIN (
    SELECT rank, shard FROM (
      SELECT rank, shard, blocks, row_number() OVER (PARTITION BY rank ORDER BY z::DOUBLE / (2 * k + 1) DESC, shard, k) AS place
      FROM (SELECT *, unnest(range(0, blocks + 1)) AS k FROM shards WHERE z > 0)) WHERE place <= blocks) q
  ON q.rank = s.rank AND q.shard = s.shard GROUP BY s.rank, s.shard, s.z
), line AS (
  SELECT dealt.*, z, quota, greatest(1, ceil(z / 64)::BIGINT) AS n,
         coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY ('0x' || substr(md5(concat(doc_id, '|', 'order', '|', 'mix-1')), 1, 8))::BIGINT,
                                  doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off,
         ('0x' || substr(md5(concat(rank, '|', shard, '|', 'start', '|', 'mix-1')), 1, 8))::BIGINT AS start
  FROM dealt JOIN quotas USING (rank, shard)
), cut AS (
  SELECT *, quota // n AS whole, start % n AS p, start % n + quota % n AS e FROM line
)
SELECT doc_id, size, source_size, target,
       least(3 * size, whole * size + greatest(0, least(size, e * 64 - off)) - greatest(0, least(size, p * 64 - off))
                       + greatest(0, least(size, greatest(0, e - n) * 64 - off)))::BIGINT AS taken
FROM cut
""")
def op9_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """Where the public byte-level vocabulary lies; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_curve_packing")
def op6_curve_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op5_html_text")
def op5_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op10_language_mixture")
def op10_language_mixture(spark, sf_dir):
    return language_mixture.identify(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_multiset_fingerprints", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), e AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM d
), both_texts AS (
  SELECT doc_id, 0 AS kind, text FROM e
  UNION ALL SELECT doc_id, 1, substr(text, 1, length(text) - length(text) // 2) || substr(after, 1, length(text) // 2) FROM e
), phrases AS (
  SELECT doc_id, kind, md5(unnest(string_split(regexp_replace(text, '([.,!?esn]) ', '\1' || chr(10), 'g'), chr(10)))) AS m FROM both_texts
), bits AS (
  SELECT doc_id, kind, ('0x' || substr(m, 1, 15))::BIGINT AS h1, ('0x' || substr(m, 16, 15))::BIGINT AS h2 FROM phrases
), lanes AS (
  SELECT doc_id, kind, lane, ((2 * sum(((CASE WHEN lane < 48 THEN h1 ELSE h2 END) >> (lane % 48 // 4 + 16 * (lane % 4))) & 1) - count(*)) % 65536 + 65536) % 65536 AS v
  FROM bits, (SELECT unnest(range(0, 96)) AS lane) GROUP BY doc_id, kind, lane
), signs AS (
  SELECT doc_id, kind, list(v::BIGINT ORDER BY lane) AS signs FROM lanes GROUP BY doc_id, kind
), paragraphs AS (
  SELECT doc_id, kind, md5(unnest(string_split(text, chr(10)))) AS m FROM both_texts
), numbers AS (
  SELECT doc_id, kind, [(sum(('0x' || substr(m, 1, 8))::BIGINT & 1073741823) % 1073741824)::BIGINT, (sum(('0x' || substr(m, 9, 8))::BIGINT & 1073741823) % 1073741824)::BIGINT,
                        (sum(('0x' || substr(m, 17, 8))::BIGINT & 1073741823) % 1073741824)::BIGINT, (sum(('0x' || substr(m, 25, 8))::BIGINT & 1073741823) % 1073741824)::BIGINT] AS numbers
  FROM paragraphs GROUP BY doc_id, kind
), f AS (
  SELECT doc_id, kind, numbers, list_transform(signs, lambda x: CASE WHEN x >= 32768 THEN x - 65536 ELSE x END) AS signed,
         array_to_string(list_transform(numbers, lambda x: lpad(lower(to_hex(x)), 8, '0')), '')
         || array_to_string(list_transform(signs, lambda x: lpad(lower(to_hex(x)), 4, '0')), '') AS fp
  FROM signs JOIN numbers USING (doc_id, kind)
), t AS (
  SELECT e.doc_id, e.text, e.next_id, b.text AS edited, o.fp, n.fp AS nfp, a.fp AS afp, o.signed AS os, n.signed AS ns, a.signed AS as_
  FROM e JOIN both_texts b ON b.doc_id = e.doc_id AND b.kind = 1 JOIN f o ON o.doc_id = e.doc_id AND o.kind = 0
  JOIN f n ON n.doc_id = e.doc_id AND n.kind = 1 JOIN f a ON a.doc_id = e.next_id AND a.kind = 0
), s AS (
  SELECT *, list_sum(list_transform(os, lambda x: x * x)) AS oo, list_sum(list_transform(ns, lambda x: x * x)) AS nn, list_sum(list_transform(as_, lambda x: x * x)) AS aa,
         list_sum(list_transform(list_zip(os, ns), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dn,
         list_sum(list_transform(list_zip(os, as_), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS da FROM t
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, nfp AS edited_fingerprint,
       CASE WHEN fp = nfp THEN 1.0 WHEN oo + nn = 0 THEN 0.0 ELSE greatest(0.0, 1 - dn::DOUBLE / (oo + nn)::DOUBLE) END::DOUBLE AS near_edited,
       CASE WHEN fp = afp THEN 1.0 WHEN oo + aa = 0 THEN 0.0 ELSE greatest(0.0, 1 - da::DOUBLE / (oo + aa)::DOUBLE) END::DOUBLE AS near_next
FROM s
""")
def op8_multiset_fingerprints(spark, sf_dir):
    return multiset_hash.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op7_masked_lm_scores")
def op7_masked_lm_scores(spark, sf_dir):
    return lm_scoring.pseudo_likelihood(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op11_line_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM k LEFT JOIN shared s ON s.key = k.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (coalesce(gone, false)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(gone, false)), '')) AS kept_sha256
FROM judged GROUP BY r
""")
def op11_line_dedup(spark, sf_dir):
    return line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"), ["doc_id"], with_text=False)


def _lloyd_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Every round as two tables: who goes where, and the entries after it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT x.row, x.p, x.w, min(list_sum(list_transform(list_zip(x.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 16 + b.e) AS m
  FROM x JOIN b{i} b ON b.p = x.p GROUP BY x.row, x.p, x.w)""")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT o.p, o.e, coalesce(n.w, o.w) AS w FROM b{i} o LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS w FROM (
      SELECT p, m % 16 AS e, j, sum(w[j])::BIGINT AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, (SELECT width + 1 FROM shape))) AS j) GROUP BY p, m % 16, j)
    GROUP BY p, e) n ON n.p = o.p AND n.e = o.e)""")
    return f"""
WITH v0 AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0
), shape AS (
  SELECT len(embedding) // 8 AS width, len(embedding) AS size FROM v0 WHERE row = (SELECT min(row) FROM v0) AND len(embedding) > 0 AND len(embedding) % 8 = 0
), v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY row) AS row, vec_id, label, list_transform(embedding, lambda z: floor(4096 * z::DOUBLE)::BIGINT) AS v
  FROM v0 WHERE len(embedding) = (SELECT size FROM shape)
), x AS MATERIALIZED (
  SELECT row, p, v[p * (SELECT width FROM shape) + 1:(p + 1) * (SELECT width FROM shape)] AS w FROM v, (SELECT unnest(range(0, 8)) AS p)
), b0 AS MATERIALIZED (SELECT p, row - 1 AS e, w FROM x WHERE row <= 16
), {", ".join(steps)}, coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(m % 16)), 2, '0'), '' ORDER BY p) AS code, sum(m // 16)::BIGINT AS error FROM a{rounds} GROUP BY row
), joined AS (
  SELECT v.vec_id, v.label, c.code, c.error FROM coded c JOIN v USING (row)
), books AS (
  SELECT sha256(string_agg(z::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM (SELECT p, e, unnest(w) AS z, unnest(range(1, len(w) + 1)) AS j FROM b{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM books) AS codebooks_sha256 FROM joined
"""


@query("op12_vector_codes", _lloyd_sql())
def op12_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


@query("op13_prefix_trie", r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  -- h: CRC-32 of the decimal id, bit by bit
  SELECT c, c - c % 100 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], range(0, 8 * length(c::VARCHAR))), lambda a, i:
           xor((CASE WHEN i % 8 = 0 THEN xor(a, ascii(substr(c::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE a END) >> 1,
               CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(a, ascii(substr(c::VARCHAR, i // 8 + 1, 1))::BIGINT) ELSE a END) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)),
         4294967295::BIGINT) % 6 AS h FROM (SELECT DISTINCT c FROM t)
), turns AS (
  SELECT i.c, t.pos AS place, t.r, t.x FROM ids i JOIN t ON t.c = i.base AND t.pos <= i.h
  UNION ALL SELECT i.c, t.pos + 6, t.r, t.x FROM ids i JOIN t ON t.c = i.c AND t.pos > i.h
), seqs AS (
  SELECT i.c, coalesce(s.s, []) AS s, coalesce(len(s.s), 0) AS n FROM ids i
  LEFT JOIN (SELECT c, list({'r': r, 'x': x} ORDER BY place) AS s FROM turns GROUP BY c) s USING (c)
), steps AS (
  SELECT c, n, d, s[1:d] AS prefix FROM (SELECT c, s, n, unnest(range(0, n + 1)) AS d FROM seqs)
), nodes AS (
  SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends
  FROM steps GROUP BY prefix, d
), kids AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), own AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, (n_convs - 1) * coalesce(length(n.prefix[depth].x), 0) AS saved FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix
), up AS (
  SELECT prefix[1:a] AS prefix, sum(saved)::BIGINT AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT prefix, saved, n_children, unnest(range(0, depth + 1)) AS a FROM own) GROUP BY 1
)
SELECT o.conv_id, o.depth, q.conv_id AS parent_conv_id, o.n_convs, o.n_children, u.leaves AS n_leaves, u.saved AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN up u ON u.prefix = o.prefix LEFT JOIN nodes q ON o.depth > 0 AND q.prefix = o.prefix[1:o.depth - 1]
""")
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
