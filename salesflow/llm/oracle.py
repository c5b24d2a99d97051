"""DuckDB SQL for the dealt operators that SQL can express."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    return {"op6_warc": OP6, "op8_mixture": OP8, "op9_exact_dedup": OP9, "op12_lexical_search": OP12}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
capped AS (SELECT *, 3.0::DOUBLE * source_size AS cap, w::DOUBLE AS weight FROM named),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM capped WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT arg_min(level, cap / weight) FILTER (cap > weight * level) AS level FROM levels),
goals AS (
  SELECT l.source, l.source_size, CASE WHEN l.cap > l.weight * l.level THEN least(l.weight * f.level, l.cap) ELSE l.cap END AS target
  FROM levels l, final f),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes,
         CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS budget
  FROM goals),
r1 AS (
  SELECT s.*, p.source_size, p.target, p.passes, p.budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= p.budget AS t1
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source),
l1 AS (SELECT *, budget - coalesce(sum(size) FILTER (t1) OVER (PARTITION BY source), 0) AS left1 FROM r1),
r2 AS (
  SELECT *, NOT t1 AND size <= left1 AS in2,
         sum(CASE WHEN NOT t1 AND size <= left1 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sum2
  FROM l1),
l2 AS (SELECT *, in2 AND sum2 <= left1 AS t2, left1 - coalesce(sum(size) FILTER (in2 AND sum2 <= left1) OVER (PARTITION BY source), 0) AS left2 FROM r2),
r3 AS (
  SELECT *, NOT t1 AND NOT t2 AND size <= left2 AS in3,
         sum(CASE WHEN NOT t1 AND NOT t2 AND size <= left2 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sum3
  FROM l2),
b3 AS (SELECT *, min(hash) FILTER (in3 AND sum3 > left2) OVER (PARTITION BY source) AS border FROM r3),
e3 AS (
  SELECT *, coalesce(sum(size) FILTER (in3 AND (border IS NULL OR hash < border)) OVER (PARTITION BY source), 0) AS below,
         coalesce(sum(size) FILTER (in3 AND hash = border) OVER (PARTITION BY source), 0) AS at_border
  FROM b3),
t3 AS (
  SELECT *, in3 AND (border IS NULL OR hash < border OR (hash = border AND below + at_border - left2 < left2 - below)) AS t3 FROM e3)
SELECT doc_id, size, source_size, target, ((passes + CASE WHEN t1 OR t2 OR t3 THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM t3
"""

OP9 = f"""
WITH plain AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM plain GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM plain JOIN grouped USING (t)
"""

OP6 = """
WITH plain AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
first AS (SELECT payload, min(page_id) AS first_id FROM plain GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(sha1(payload), (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM plain JOIN first USING (payload)
"""

OP12 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '%s', '%s'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
posted AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM posted GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM posted GROUP BY term), corpus),
norms AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // terms) AS m FROM lengths, corpus),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '%s', '%s'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN posted USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""" % ((UPPER, LOWER) * 2)
