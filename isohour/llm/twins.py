"""SQL twins of the operators that SQL can express: the same rows by plain joins, for small tables."""

from __future__ import annotations

from isohour.llm.common import WORD

#: (node, root) for every root that reaches the node over nodes not below the root; the least is the component.
REACHED = """
reached(id, root) AS (
  SELECT a, a FROM links
  UNION
  SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id WHERE l.b > r.root
), component AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id)"""

#: Shingles are looked up by the rarest of each set: sets of similarity 0.8 share one of the first fifth.
NEAR_DUPLICATES = f"""
WITH RECURSIVE parts AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
                      WHEN len(w) = 1 THEN w
                      ELSE list_distinct(list_transform(list_zip(w[:-2], w[2:]), lambda z: z[1] || ' ' || z[2])) END AS s
  FROM parts
), single AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
counted AS (SELECT *, count(*) OVER (PARTITION BY shingle) AS docs FROM single),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY docs, shingle) AS k FROM counted),
first AS (SELECT doc_id, n, shingle FROM ranked WHERE k <= n - ceil(n * 0.8) + 1),
pairs AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM first a JOIN first b USING (shingle)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), common AS (
  SELECT a, b, len(x.s) AS na, len(y.s) AS nb, len(list_intersect(x.s, y.s)) AS shared
  FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
), one_way AS (SELECT a, b FROM common WHERE 100 * shared >= 80 * (na + nb - shared)),
links AS (SELECT a, b FROM one_way UNION ALL SELECT b, a FROM one_way),{REACHED}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN component ON id = doc_id"""

NEAR_VECTORS = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), normed AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM sound),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b USING (label)
  WHERE a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0
    AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= CAST(0.98 AS DOUBLE)
),{REACHED}, degree AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component c ON c.id = vec_id LEFT JOIN degree d ON d.id = vec_id"""

#: Bytes are pairs of hexadecimal digits; starts count from 0. Blocks of 200 starts keep substrings cheap in long texts.
REPEATED_PASSAGES = r"""
WITH bodies AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
firsts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 200)) AS base FROM bodies),
blocks AS (SELECT doc_id, base, substr(h, 2 * base + 1, 1198) AS h FROM firsts),
starts AS (SELECT doc_id, base, h, unnest(range(len(h) // 2 - 399)) AS j FROM blocks),
windows AS (SELECT doc_id, base + j AS i, md5_number(substr(h, 2 * j + 1, 800)) AS passage FROM starts),
repeated AS (
  SELECT doc_id, i FROM windows WHERE passage IN (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1)
), before AS (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM repeated),
runs AS (
  SELECT doc_id, i, sum(CASE WHEN i <= last + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM before
), spans AS (SELECT doc_id, min(i) AS s, max(i) + 400 AS e FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS open FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last,
         string_agg(substr(h, 2 * open + 1, 2 * (s - open)), '' ORDER BY s) AS head
  FROM gaps JOIN bodies USING (doc_id) GROUP BY doc_id
), remaining AS (
  SELECT doc_id, h, n_removed, n_spans, coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1) AS kept
  FROM bodies LEFT JOIN cut USING (doc_id)
)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256,
       decode(unhex(regexp_replace(kept, '((?:[0-7].)|(?:(?:C[2-9A-F]|D.)[89AB].)|(?:E.[89AB].[89AB].)|(?:F[0-4][89AB].[89AB].[89AB].))|..', '\1', 'g'))) AS text
FROM remaining"""

#: Windows of each length that occurs are looked up at every place of every document.
LEAKS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), cut AS (SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM cut)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, size, k, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM docs, sizes)
), hits AS (SELECT r, k, size, item_id FROM places JOIN windows USING (size, words)),
hit_words AS (
  SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS spot FROM (SELECT DISTINCT r, k, size FROM hits)) GROUP BY r
), found AS (SELECT r, list_sort(list(DISTINCT item_id)) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN found USING (r)"""

#: Lines are the parts between line ends; the parts before a cut are joined again.
MIDDLES = """
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), drawn AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts,
         CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CAST(suffix(text, chr(10)) AS INTEGER) END AS n,
         CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
         CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM numbered
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 AS plain
  FROM drawn
), ends AS (
  SELECT *, CASE WHEN low = 0 THEN 0 WHEN low = n THEN length(text)
                 ELSE length(array_to_string(parts[1:low], chr(10))) + 1 END AS a,
         CASE WHEN high = 0 THEN 0 WHEN high = n THEN length(text)
              ELSE length(array_to_string(parts[1:high], chr(10))) + 1 END AS b
  FROM cuts
), formed AS (
  SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1, length(text) - b) AS rest
  FROM ends
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN NOT plain THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || rest || '<M>' || middle
              ELSE '<S>' || rest || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed"""
