"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from .licenses import LEAST_SHARE, templates
from .sharding import MULTIPLIER

# CRC-32 over the bytes of a text, eight shift steps to a byte; the text's bytes
# come from its hexadecimal form.
_STEP = "CASE WHEN {c} % 2 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
_CRC = """
  xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[1 + xor(c, b) % 256])), 4294967295::BIGINT)
"""

SHARDS = f"""
WITH RECURSIVE entries AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS n FROM range(256) t(i)
  UNION ALL
  SELECT i, {_STEP.format(c="c")}, n + 1 FROM entries WHERE n < 8
), crcs AS (SELECT list(c ORDER BY i) AS crc_table FROM entries WHERE n = 8),
rows_ AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
walk AS (
  SELECT id, -1::BIGINT AS b, 0::BIGINT AS j,
    CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616
      ELSE coalesce(doc_id, 0)::HUGEINT END AS k
  FROM rows_
  UNION ALL
  SELECT id, j, floor((j + 1) * (2147483648::DOUBLE / ((
      ((k * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616) // 8589934592) + 1)::DOUBLE))::BIGINT,
    (k * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616
  FROM walk WHERE j < 17
), placed AS (
  SELECT id, max(b) FILTER (b < 16)::INTEGER AS shard, max(b) FILTER (b < 17)::INTEGER AS grown_shard
  FROM walk GROUP BY id
), digest AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    ({_CRC})::BIGINT AS text_crc32, 'key' AS law, shard, grown_shard
  FROM rows_ JOIN placed USING (id), crcs
)
SELECT *, row_number() OVER (
  PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM digest
"""


def _template_rows() -> str:
    return ", ".join(
        f"({t}, '{label}', {str(base).lower()}, {place}, '{word}', {str(needed).lower()})"
        for t, label, base, place, word, needed in templates()
    )


LICENSES = f"""
WITH rows_ AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
parsed AS (
  SELECT id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM rows_
), spots AS (
  SELECT id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS position FROM parsed
), template(t, label, base, place, word, needed) AS (VALUES {_template_rows()}),
known AS (SELECT spots.* FROM spots WHERE word IN (SELECT word FROM template)),
found AS (SELECT word, count(DISTINCT id) AS files FROM known GROUP BY word),
weighed AS (
  SELECT template.*, floor(1000 * ln(
    ((SELECT count(*) FROM rows_) + 2)::DOUBLE / (coalesce(files, 0) + 1)))::BIGINT AS weight
  FROM template LEFT JOIN found USING (word)
), whole AS (
  SELECT t, sum(weight) AS whole, count(*) FILTER (needed) AS phrase FROM weighed GROUP BY t
), places AS (
  SELECT id, t, position - place AS start, any_value(label) AS label, any_value(base) AS base,
    count(*) FILTER (needed) AS met, sum(weight) AS weight
  FROM known JOIN weighed USING (word) GROUP BY ALL
), complete AS (
  SELECT id, start, label, base, weight::DOUBLE / greatest(whole, 1)::DOUBLE AS share
  FROM places JOIN whole USING (t) WHERE met = phrase
), told AS (
  SELECT id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    list_sort(list(DISTINCT label) FILTER (base)) AS base_set,
    list_sort(list(DISTINCT label) FILTER (base OR share >= {LEAST_SHARE})) AS all_set,
    max(share) AS score
  FROM complete GROUP BY id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base_set, ','), '') AS base_labels,
  coalesce(array_to_string(all_set, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM parsed LEFT JOIN told USING (id)
"""


def _record(body: str) -> str:
    return (
        "'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || "
        "'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || "
        "chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || "
        f"'Content-Length: ' || octet_length(encode({body})) || chr(13) || chr(10) || chr(13) || "
        f"chr(10) || {body} || chr(13) || chr(10) || chr(13) || chr(10)"
    )


FIXITY = f"""
WITH harmed AS (
  SELECT row_number() OVER () AS id, page_id, url, coalesce(html, '') AS html,
    coalesce(page_id % 97, 0) AS residue,
    CASE coalesce(page_id % 97, 0) WHEN 1 THEN chr(1) || substr(coalesce(html, ''), 2)
      WHEN 3 THEN substr(coalesce(html, ''), 1, length(coalesce(html, '')) // 2)
      ELSE coalesce(html, '') END AS copy
  FROM pages
), records AS (
  SELECT id, page_id, residue, floor(coalesce(page_id, -1) / 1024.0)::BIGINT AS file,
    {_record("html")} AS record, {_record("copy")} AS copied
  FROM harmed
), laid AS (
  SELECT *, octet_length(encode(record))::BIGINT AS length, sha256(record) AS digest,
    octet_length(encode(copied))::BIGINT AS copy_length, sha256(copied) AS copy_digest,
    (sum(octet_length(encode(record))) OVER (
      PARTITION BY file ORDER BY page_id NULLS FIRST, id ROWS UNBOUNDED PRECEDING)
      - octet_length(encode(record)))::BIGINT AS start
  FROM records
)
SELECT page_id, file, start, length, digest,
  CASE WHEN residue <> 2 THEN copy_length END AS replica_length,
  CASE WHEN residue <> 2 THEN copy_digest END AS replica_digest,
  CASE WHEN residue = 2 THEN 'missing' ELSE 'changed' END AS state
FROM laid WHERE residue = 2 OR digest <> copy_digest
"""

NEAREST = """
WITH vectors AS (
  SELECT row_number() OVER () AS id, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
    AND len(list_filter(embedding, lambda x: NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.id AS own, q.vec_id AS query_id, c.vec_id, c.id,
    list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST, id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


DIVERGENCE = r"""
WITH rows_ AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), listed AS (SELECT id, lang, source, unnest(terms) AS term FROM rows_),
counted AS (SELECT lang, source, term, count(*) AS c FROM listed GROUP BY ALL),
kept AS (
  SELECT lang, term, count(*) AS c FROM listed GROUP BY lang, term HAVING count(DISTINCT id) >= 3
),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM rows_),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c, k.c AS lang_c
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted x USING (lang, source, term)
), totals AS (SELECT lang, source, sum(c) AS n FROM dense GROUP BY ALL),
shares AS (
  SELECT d.lang, d.source, d.term, d.c,
    (1 + 1000000000::HUGEINT * (d.c + 1) // (t.n + l.v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (d.lang_c + 1) // (l.n + l.v))::BIGINT AS q
  FROM dense d JOIN totals t USING (lang, source) JOIN langs l USING (lang)
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(s.value, 0)::BIGINT AS value, 9223372036854775807 AS most
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value,
    200::BIGINT AS most
  FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE rank <= most
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sharding": SHARDS,
        "op2_license_scan": LICENSES,
        "op5_fixity": FIXITY,
        "op6_nearest": NEAREST,
        "op13_divergence": DIVERGENCE,
    }
