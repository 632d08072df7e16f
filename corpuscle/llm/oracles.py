"""The queries of this package in DuckDB SQL, where SQL can express them."""

from __future__ import annotations


OP4 = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM m
"""

_OP11_START = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, [floor(4096 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS MATERIALIZED (
  SELECT row, vec_id, part, e[part * len(e) // 8 + 1 : (part + 1) * len(e) // 8] AS x FROM v, range(8) AS parts(part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p
  QUALIFY entry < 16
)"""

_OP11_ASSIGN = """
a{n} AS MATERIALIZED (
  SELECT row, part, any_value(x) AS x, min({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c), 'entry': entry}}) AS best
  FROM p JOIN c{n} USING (part) GROUP BY row, part
)"""

_OP11_MEAN = """
s{n} AS (
  SELECT part, best.entry AS entry, pos, count(*) AS n, CAST(sum(x[pos]) AS BIGINT) AS s
  FROM a{before}, range(1, 1025) AS places(pos) WHERE pos <= len(x) GROUP BY ALL
), m{n} AS (
  SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS m FROM s{n} GROUP BY part, entry
), c{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM c{before} LEFT JOIN m{n} USING (part, entry)
)"""

_OP11_END = """
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN (
  SELECT row, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY row
) USING (row), (
  SELECT sha256(string_agg(CAST(CAST(c[pos] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM c{rounds}, range(1, 1025) AS places(pos) WHERE pos <= len(c)
)
"""


def op11(rounds: int = 6) -> str:
    steps = [_OP11_START, _OP11_ASSIGN.format(n=0)]
    for n in range(1, rounds + 1):
        steps += [_OP11_MEAN.format(n=n, before=n - 1), _OP11_ASSIGN.format(n=n)]
    return ",".join(steps) + _OP11_END.format(rounds=rounds)


OP13 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_uniform_threshold_topk": OP4,
        "op8_warc_chunks": OP8,
        "op11_hilbert_block_codes": op11(),
        "op13_digest_runs": OP13,
    }
