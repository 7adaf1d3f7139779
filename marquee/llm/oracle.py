"""DuckDB statements equal to the registered queries of the subpackage."""

from __future__ import annotations

OP1_LM_SCORING = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS wanted,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), tokens AS (
  SELECT d, wanted, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
), counted AS (
  SELECT word, count(*) AS b, count(*) FILTER (WHERE wanted) AS t,
         least((length(word) - 1) // 4, 3) + CASE WHEN regexp_matches(word, '[!-@\[-`{-~]') THEN 4 ELSE 0 END AS kind
  FROM tokens GROUP BY word
), words AS (
  SELECT word, b, t, kind, b * 1024 >= (SELECT count(*) FROM tokens) AS own FROM counted
), kinds AS (
  SELECT kind, sum(b) + 0.5::DOUBLE * count(*) AS b, sum(t) + 0.5::DOUBLE * count(*) AS t FROM words WHERE NOT own GROUP BY kind
), symbols AS (
  SELECT w.word, CASE WHEN w.own THEN 'w' || w.word ELSE 'c' || w.kind END AS s,
         CASE WHEN w.own THEN 0 ELSE -ln((w.b + 0.5::DOUBLE) / k.b) END AS b,
         CASE WHEN w.own THEN 0 ELSE -ln((w.t + 0.5::DOUBLE) / k.t) END AS t
  FROM words w LEFT JOIN kinds k ON k.kind = w.kind
), named AS (
  SELECT t.d, t.wanted, t.i, y.s, y.b, y.t FROM tokens t JOIN symbols y ON y.word = t.word
), pairs AS (
  SELECT d, wanted, coalesce(lag(s) OVER (PARTITION BY d ORDER BY i), '^') AS h, s, b, t FROM named
), size AS (
  SELECT count(*) + 8 AS n FROM words WHERE own
), cells AS (
  SELECT h, s, count(*) AS b, count(*) FILTER (WHERE wanted) AS t FROM pairs GROUP BY h, s
), hist AS (
  SELECT h, sum(b) AS b, sum(t) AS t FROM cells GROUP BY h
), uni AS (
  SELECT s, (sum(b) + 0.5::DOUBLE) / ((SELECT sum(b) FROM cells) + 0.5::DOUBLE * (SELECT n FROM size)) AS b,
            (sum(t) + 0.5::DOUBLE) / ((SELECT sum(t) FROM cells) + 0.5::DOUBLE * (SELECT n FROM size)) AS t
  FROM cells GROUP BY s
), loss AS (
  SELECT c.h, c.s,
         -ln(CASE WHEN h.b > 0 THEN 0.75::DOUBLE * (c.b::DOUBLE / h.b) + 0.25::DOUBLE * u.b ELSE u.b END) AS b,
         -ln(CASE WHEN h.t > 0 THEN 0.75::DOUBLE * (c.t::DOUBLE / h.t) + 0.25::DOUBLE * u.t ELSE u.t END) AS t
  FROM cells c JOIN hist h ON h.h = c.h JOIN uni u ON u.s = c.s
), scored AS (
  SELECT p.d, avg(l.t + p.t) AS t, avg(l.b + p.b) AS b FROM pairs p JOIN loss l ON l.h = p.h AND l.s = p.s GROUP BY p.d
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, round(s.t, 6) AS loss_target, round(s.b, 6) AS loss_background,
       round(s.t - s.b, 6) AS score
FROM docs d LEFT JOIN scored s ON s.d = d.d
"""

OP2_SHARDING = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i:
           list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i::BIGINT)) AS t
), byte_list AS (
  SELECT doc_id, text,
         list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
  FROM documents
), hashed AS (
  SELECT b.doc_id, (coalesce(strlen(b.text), 0) + 1)::BIGINT AS size,
         xor(4294967295, list_reduce(b.bytes, lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32,
         ((('0x' || substr(md5(coalesce(b.doc_id::VARCHAR, '')), 1, 8))::BIGINT) % 4096)::INT AS vslot
  FROM byte_list b, crc_table t
), hot AS (
  SELECT doc_id FROM hashed GROUP BY doc_id
  HAVING count(*) > 1 AND sum(size) * 8 * 16 > (SELECT sum(size) FROM hashed)
), records AS (
  SELECT h.doc_id, h.size, h.text_crc32,
         CASE WHEN EXISTS (SELECT 1 FROM hot WHERE hot.doc_id IS NOT DISTINCT FROM h.doc_id)
              THEN (((('0x' || substr(md5(concat_ws('/', h.doc_id, h.size, h.text_crc32)), 1, 8))::BIGINT) % 4096
                    + row_number() OVER (PARTITION BY h.doc_id, h.size, h.text_crc32) - 1) % 4096)::INT
              ELSE h.vslot END AS vslot
  FROM hashed h
), loads AS (
  SELECT s.vslot::INT AS vslot, (s.vslot % 16)::INT AS shard,
         coalesce(sum(r.size), 0)::BIGINT AS bytes, count(r.size) AS n_rows
  FROM range(4096) s(vslot) LEFT JOIN records r ON r.vslot = s.vslot GROUP BY ALL
), marked AS (
  SELECT *, sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, vslot ROWS UNBOUNDED PRECEDING) * 16
            <= sum(bytes) OVER () AS fits
  FROM loads
), pool AS (
  SELECT vslot, bytes, row_number() OVER (ORDER BY bytes DESC, vslot) AS i FROM marked WHERE NOT fits
), walk(i, vslot, shard, now) AS (
  SELECT 0::BIGINT, -1, -1, (SELECT list(coalesce(b, 0)::BIGINT ORDER BY s) FROM range(16) k(s)
                     LEFT JOIN (SELECT shard, sum(bytes) AS b FROM marked WHERE fits GROUP BY shard) m ON m.shard = k.s)
  UNION ALL
  SELECT p.i, p.vslot, (list_position(w.now, list_min(w.now)) - 1)::INT,
         list_transform(w.now, lambda v, j: CASE WHEN j = list_position(w.now, list_min(w.now)) THEN v + p.bytes ELSE v END)
  FROM walk w JOIN pool p ON p.i = w.i + 1
), placed AS (
  SELECT m.vslot, coalesce(w.shard, m.shard)::INT AS shard, m.n_rows
  FROM marked m LEFT JOIN walk w ON w.vslot = m.vslot
), offsets AS (
  SELECT vslot, shard, coalesce(sum(n_rows) OVER (PARTITION BY shard ORDER BY vslot
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM placed
)
SELECT r.doc_id, r.size, r.text_crc32::BIGINT AS text_crc32, 'bytes' AS law, o.shard,
       (o.before + row_number() OVER (PARTITION BY r.vslot ORDER BY r.doc_id NULLS FIRST, r.text_crc32 NULLS FIRST, r.size) - 1)::BIGINT AS slot,
       NULL::INT AS grown_shard, r.vslot
FROM records r JOIN offsets o ON o.vslot = r.vslot
"""

OP3_DECONTAMINATION = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, len(least_w) AS n, array_to_string(least_w, ' ') AS win
  FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 10, 0)::BIGINT + 2),
                                 lambda i: list_slice(w, i, i + 9))) AS least_w
        FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), lengths AS (
  SELECT DISTINCT n FROM wins
), doc_wins AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, lengths WHERE len(w) >= n
), hits AS (
  SELECT d.doc_id, d.n, d.i, x.item_id
  FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM doc_wins) d
  JOIN wins x ON x.win = d.win AND x.n = d.n
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit,
       coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

OP4_MIXING = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source
), dealt(round, source, source_size, weight, target, full_now) AS (
  SELECT 0, source, source_size, weight, 0.0::DOUBLE, false FROM sizes
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         CASE WHEN full_now THEN target ELSE weight * level END,
         full_now OR weight * level >= 2 * source_size
  FROM (SELECT *, (1.5 * sum(source_size) OVER () - sum(CASE WHEN full_now THEN 2 * source_size ELSE 0 END) OVER ())
                  / nullif(sum(CASE WHEN full_now THEN 0 ELSE weight END) OVER (), 0) AS level FROM dealt)
  WHERE round <= (SELECT count(*) FROM sizes)
), targets AS (
  SELECT source, source_size, CASE WHEN full_now THEN (2 * source_size)::DOUBLE ELSE target END AS target
  FROM dealt WHERE round = (SELECT max(round) FROM dealt)
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
         floor(target)::BIGINT - CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END * source_size AS part
  FROM targets
), ordered AS (
  SELECT d.*, p.source_size, p.target, p.epochs, p.part,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, part - before)))::BIGINT AS taken
FROM ordered
"""

OP8_NEAR_DUPS = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                                              lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM texts
), shingles AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), least AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.x = s.doc_id
"""

OP9_URLS = r"""
WITH split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(action, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fitting AS (
  SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN regexp_matches(host, 'casino|free-bets|spam-farm|adult-') THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting
"""


def _clustering(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds, one group of common table expressions each, comparing all pairs of vector and centroid."""
    placed = """a{0} AS MATERIALIZED (
  SELECT r, min(d) AS d, arg_min(c, (d, c)) AS c FROM (
    SELECT kept.r, centre.c, list_sum(list_transform(list_zip(kept.x, centre.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept, c{0} centre) GROUP BY r
)"""
    moved = """c{1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.x, o.x) AS x FROM c{0} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM (
      SELECT c, pos, sum(v)::BIGINT AS s, count(*)::BIGINT AS n
      FROM (SELECT a.c, unnest(range(64)) AS pos, unnest(kept.x) AS v FROM a{0} a JOIN kept ON kept.r = a.r)
      GROUP BY c, pos) GROUP BY c) m ON m.c = o.c
)"""
    steps = [part.format(i, i + 1) for i in range(rounds) for part in (placed, moved)] + [placed.format(rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64 AND len(embedding) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS c, x FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), x) <= {k}
), {", ".join(steps)}
SELECT kept.vec_id, a.c::INT AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(centre.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept ON kept.r = a.r JOIN c{rounds} centre ON centre.c = a.c
"""


OP13_CENTROIDS = _clustering()

OP11_REPEATS = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(encode(text), ''::BLOB) AS b FROM documents
), windows AS (
  SELECT r, p, md5(b[p:p + 399]) AS h
  FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS p FROM docs WHERE octet_length(b) >= 400)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1
), marked AS (
  SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM twice
), numbered AS (
  SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM marked
), spans AS (
  SELECT r, g, min(p) AS lo, max(p) + 399 AS hi FROM numbered GROUP BY r, g
), left_over AS (
  SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) + 1 AS a, lo - 1 AS z FROM spans
  UNION ALL
  SELECT r, max(hi) + 1, NULL FROM spans GROUP BY r
), rest AS (
  SELECT l.r, sha256(unhex(string_agg(hex(d.b[l.a:coalesce(l.z, octet_length(d.b))]), '' ORDER BY l.a))) AS sha
  FROM left_over l JOIN docs d ON d.r = l.r WHERE l.a <= coalesce(l.z, octet_length(d.b)) GROUP BY l.r
), sums AS (
  SELECT r, sum(hi - lo + 1) AS removed, count(*) AS n FROM spans GROUP BY r
)
SELECT d.doc_id, octet_length(d.b)::BIGINT AS n_bytes, coalesce(s.removed, 0)::BIGINT AS n_removed, coalesce(s.n, 0)::BIGINT AS n_spans,
       CASE WHEN s.r IS NULL THEN sha256(d.b) ELSE coalesce(rest.sha, sha256(''::BLOB)) END AS kept_sha256
FROM docs d LEFT JOIN sums s ON s.r = d.r LEFT JOIN rest ON rest.r = d.r
"""

SQL = {
    "op1_lm_scoring": OP1_LM_SCORING,
    "op2_sharding": OP2_SHARDING,
    "op3_decontamination": OP3_DECONTAMINATION,
    "op4_mixing": OP4_MIXING,
    "op8_near_dups": OP8_NEAR_DUPS,
    "op9_url_filter": OP9_URLS,
    "op11_repeats": OP11_REPEATS,
    "op13_centroids": OP13_CENTROIDS,
}
