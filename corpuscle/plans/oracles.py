"""The registered queries once more, as plain SQL over the same tables."""

from __future__ import annotations

from corpuscle.plans.queries import (
    CACHE_THRESHOLD,
    LOOSE_THRESHOLD,
    NPROBE,
    REPLAY_THRESHOLD,
    SAMPLED,
    SWEEP_THRESHOLDS,
    TOP_N,
)

# Character classes as Python's str methods see them.
_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_BLANK = (
    r"\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
_NAMES = (
    "'from','subject','organization','lines','nntp-posting-host','message-id','references','date',"
    "'distribution','reply-to','newsgroups','x-newsreader','x-mailer','path','summary','keywords',"
    "'mime-version','content-type','article-i.d.','sender','approved','followup-to','expires',"
    "'supersedes','archive-name','version','x-posted-to','return-path'"
)


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g')"


def _lines(text: str) -> str:
    """Lines without the empty one after a final line break."""
    pieces = f"regexp_split_to_array({text}, '{_BREAK}')"
    return f"(CASE WHEN {pieces}[-1] = '' THEN {pieces}[:-2] ELSE {pieces} END)"


_HEADER = (
    rf"(regexp_matches(l, '^[A-Za-z0-9-]+[{_BLANK}]*:') OR "
    rf"lower({_strip('''split_part(l, ':', 1)''')}) IN ({_NAMES}))"
)
_WRAPPED = (
    "'From: writer' || doc_id || '@example.org' || chr(10) || 'X-Lang : ' || lang || chr(10) || 'Subject' "
    "|| chr(10) || 'Article-I.D.: ' || doc_id || chr(10) || chr(10) || '  ' || text || repeat(chr(10), 4) "
    "|| ' > earlier words of ' || source || chr(10) || 'last line' || chr(10) || '-- ' || chr(10) "
    "|| 'sent by ' || source || chr(10)"
)
_RAW = (
    f"raw AS (SELECT doc_id AS doc_seq, source || '/' || doc_id AS doc_id, source AS category, "
    f"{_WRAPPED} AS text FROM documents)"
)
_BODY = f"""
split AS (SELECT *, {_lines('text')} AS ls FROM raw),
ended AS (SELECT *, list_position(list_transform(ls, lambda l: NOT {_HEADER}), true) AS stop FROM split),
body AS (SELECT *, CASE WHEN stop IS NULL OR stop = 0 THEN []
    WHEN {_strip('ls[stop]')} = '' THEN ls[stop + 1:] ELSE ls[stop:] END AS kept FROM ended)"""


def _without_quotes(lines: str) -> str:
    sig = (
        f"list_position(list_transform({lines}, lambda l: {_strip('l')} IN "
        "('--', repeat('-', 10), repeat('-', 74))), true)"
    )
    cut = f"(CASE WHEN coalesce({sig}, 0) > 0 THEN {lines}[:{sig} - 1] ELSE {lines} END)"
    return f"list_filter({cut}, lambda l: NOT starts_with({_strip('l')}, '>'))"


def _normal(text: str) -> str:
    return _strip(f"regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def _join(lines: str) -> str:
    return f"coalesce(array_to_string({lines}, chr(10)), '')"


_CLEAN = (
    f"{_RAW}, {_BODY}, clean AS (SELECT doc_seq, doc_id, category, "
    f"{_normal(_join(_without_quotes('kept')))} AS text FROM body)"
)
_TOKENS = f"len(regexp_extract_all(text, '[^{_BLANK}]+'))"
_USABLE = f"""{_CLEAN},
usable AS (SELECT doc_seq, doc_id, category, text FROM clean WHERE {_TOKENS} >= 50
    QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_seq) = 1)"""

# Every byte of the UTF-8 text as one character.
_BYTES = (
    "array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'), "
    "lambda h: chr(('0x' || h)::INTEGER)), '')"
)

# --- vectors --------------------------------------------------------------

_VECTORS = """
vecs AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
cells AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vecs),
centres AS MATERIALIZED (SELECT cluster, list(m ORDER BY pos) AS c FROM
    (SELECT label AS cluster, pos, avg(x) AS m FROM cells GROUP BY ALL) GROUP BY cluster)"""


def _memberships(rows: str, name: str = "u") -> str:
    """CTE ``name``(vec_id, cluster, u, d) from a relation (vec_id, v)."""
    return f"""
{name}_dist AS (SELECT r.vec_id, cluster, greatest(list_distance(r.v, c), 2.220446049250313e-16) AS d
    FROM {rows} r, centres),
{name} AS MATERIALIZED (SELECT vec_id, cluster, d,
    (1 / (d * d)) / sum(1 / (d * d)) OVER (PARTITION BY vec_id) AS u FROM {name}_dist)"""


def _dominant(source: str, name: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT vec_id, cluster FROM {source} "
        "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY u DESC, cluster) = 1)"
    )


_FORWARD = _memberships("vecs") + ", " + _dominant("u", "dom")
_REVERSED = (
    "reversed AS (SELECT vec_id, list_reverse(v) AS v FROM vecs), "
    + _memberships("reversed", "ru")
    + ", "
    + _dominant("ru", "rdom")
)


def _round(x: str, digits: int) -> str:
    return f"(round({x}, {digits}) + 0.0)"


_SCORE = "round(list_dot_product(a.v, b.v), 12)"
_KNN = f"""
pairs AS (SELECT a.vec_id AS seq, b.vec_id AS doc_id, {_SCORE} AS score FROM vecs a, vecs b),
best AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY score DESC, doc_id) AS id FROM pairs)"""
_HIT = "concat_ws(':', id, category, format('{:.4f}', round(score, 4)), length(text))"
_STRIPPED_DOCS = f"docs AS (SELECT doc_id, source AS category, {_strip('text')} AS text FROM documents)"

_LABELINGS = """
labelings AS (SELECT k::INTEGER AS k, (label % k)::INTEGER AS label, vec_id, v
    FROM vecs, range(1, 13) t(k))"""


def _silhouette(source: str) -> str:
    """Pairwise definition: mean distance to the own and to the nearest other cluster."""
    return f"""
sims AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, 1 - list_cosine_similarity(a.v, b.v) AS d
    FROM vecs a, vecs b WHERE a.vec_id <> b.vec_id),
means AS (SELECT x.k, x.vec_id, x.label, y.label AS other, avg(d) AS d
    FROM {source} x JOIN sims ON sims.a = x.vec_id JOIN {source} y ON y.k = x.k AND y.vec_id = sims.b
    GROUP BY ALL),
sides AS (SELECT k, vec_id, label, min(d) FILTER (WHERE other = label) AS inner_d,
    min(d) FILTER (WHERE other <> label) AS outer_d FROM means GROUP BY ALL),
scores AS (SELECT k, CASE WHEN count(DISTINCT label) < 2 OR count(DISTINCT label) >= count(*) THEN -1.0
    ELSE avg(CASE WHEN inner_d IS NULL THEN 0 ELSE (outer_d - inner_d) / greatest(inner_d, outer_d) END)
    END AS silhouette FROM sides GROUP BY k)"""


_LOOKUP = f"""
found AS MATERIALIZED (SELECT a.vec_id AS seq, rdom.cluster AS dominant_cluster, b.vec_id AS entry_seq,
    {_SCORE} AS score,
    CASE WHEN a.vec_id % 4 = 0 THEN {LOOSE_THRESHOLD} ELSE {CACHE_THRESHOLD} END AS threshold
    FROM reversed a JOIN rdom USING (vec_id) LEFT JOIN (SELECT vec_id, v, cluster FROM vecs JOIN dom USING (vec_id)) b
    ON b.cluster = rdom.cluster
    QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC NULLS LAST, b.vec_id) = 1)"""
_LOOKED_UP = f"WITH {_VECTORS}, {_FORWARD}, {_REVERSED}, {_LOOKUP}"


def _played(flush: str, threshold: float, old: bool = False) -> str:
    """The log played row by row: each step holds the live entries of one bucket.

    ``played``(seq, era, cluster, hit, source, score). With ``old`` the reversed
    vectors are cached before the first row, numbered below the log.
    """
    items = "SELECT vec_id AS item, v, cluster FROM vecs JOIN dom USING (vec_id)"
    if old:
        items += (
            " UNION ALL SELECT r.vec_id - 1000000, r.v, rdom.cluster "
            "FROM reversed r JOIN rdom USING (vec_id)"
        )
        start = "coalesce((SELECT list(o.item ORDER BY o.item) FROM items o WHERE o.item < 0 AND o.cluster = bucket.cluster), []::BIGINT[])"
    else:
        start = "[]::BIGINT[]"
    return f"""
items AS MATERIALIZED ({items}),
log AS (SELECT vec_id AS seq, {flush} AS flush,
    sum(CASE WHEN {flush} THEN 1 ELSE 0 END) OVER (ORDER BY vec_id) AS era FROM vecs),
places AS MATERIALIZED (SELECT seq, era, cluster,
    row_number() OVER (PARTITION BY era, cluster ORDER BY seq) AS place
    FROM log JOIN items ON item = seq WHERE NOT flush),
near AS MATERIALIZED (SELECT a.item AS seq, b.item AS entry, {_SCORE} AS score
    FROM items a JOIN items b ON a.cluster = b.cluster AND b.item < a.item WHERE a.item >= 0),
steps AS (
    SELECT era, cluster, 0::BIGINT AS place, NULL::BIGINT AS seq, false AS hit, NULL::BIGINT AS source,
        NULL::DOUBLE AS score, {start} AS live
    FROM (SELECT DISTINCT era, cluster FROM places) bucket
    UNION ALL
    SELECT era, cluster, place, seq, score >= {threshold}, CASE WHEN score >= {threshold} THEN entry ELSE seq END,
        score, CASE WHEN score >= {threshold} THEN live ELSE list_append(live, seq) END
    FROM (SELECT p.era, p.cluster, p.place, p.seq, s.live, coalesce(n.entry, -1) AS entry,
            coalesce(n.score, -1.0) AS score
        FROM steps s JOIN places p ON p.era = s.era AND p.cluster = s.cluster AND p.place = s.place + 1
        LEFT JOIN near n ON n.seq = p.seq AND list_contains(s.live, n.entry)
        QUALIFY row_number() OVER (PARTITION BY p.seq ORDER BY n.score DESC NULLS LAST, n.entry) = 1)),
played AS MATERIALIZED (SELECT seq, era::BIGINT AS era, cluster, hit, source, score FROM steps WHERE place > 0)"""


def _replayed(flush: str, threshold: float = REPLAY_THRESHOLD) -> str:
    return f"WITH RECURSIVE {_VECTORS}, {_FORWARD}, {_played(flush, threshold)}"


_FLUSH = "vec_id % 170 = 169"


# Texts that come again, with thresholds of their own: a text keeps the place of its first entry,
# and a hit answers with what was written to it last.
_REPEATED = f"""WITH RECURSIVE {_VECTORS}, {_FORWARD},
log AS (SELECT vec_id AS seq, {_FLUSH} AS flush, CASE WHEN vec_id % 2 = 1 THEN vec_id // 4 ELSE vec_id END AS wanted,
    CASE vec_id % 5 WHEN 0 THEN {LOOSE_THRESHOLD} WHEN 1 THEN 1.0 ELSE {REPLAY_THRESHOLD} END AS threshold,
    sum(CASE WHEN {_FLUSH} THEN 1 ELSE 0 END) OVER (ORDER BY vec_id) AS era FROM vecs),
items AS MATERIALIZED (SELECT seq, era, flush, threshold, vec_id AS same, v, cluster,
    row_number() OVER (PARTITION BY era, cluster, flush ORDER BY seq) AS place
    FROM (SELECT log.*, coalesce(b.vec_id, seq) AS of FROM log LEFT JOIN vecs b ON b.vec_id = wanted)
    JOIN vecs ON vec_id = of JOIN dom USING (vec_id)),
near AS MATERIALIZED (SELECT a.seq, b.seq AS entry, a.same = b.same AS own, {_SCORE} AS score
    FROM items a JOIN items b ON a.era = b.era AND a.cluster = b.cluster AND b.seq < a.seq WHERE NOT a.flush AND NOT b.flush),
steps AS (
    SELECT era, cluster, 0::BIGINT AS place, NULL::BIGINT AS seq, false AS hit, NULL::BIGINT AS entry, []::BIGINT[] AS live
    FROM (SELECT DISTINCT era, cluster FROM items) bucket
    UNION ALL
    SELECT era, cluster, place, seq, score >= threshold, CASE WHEN score >= threshold THEN entry ELSE coalesce(own, seq) END,
        CASE WHEN score >= threshold OR own IS NOT NULL THEN live ELSE list_append(live, seq) END
    FROM (SELECT p.era, p.cluster, p.place, p.seq, p.threshold, s.live, n.entry, coalesce(n.score, -1.0) AS score,
            max(CASE WHEN n.own THEN n.entry END) OVER (PARTITION BY p.seq) AS own
        FROM steps s JOIN items p ON p.era = s.era AND p.cluster = s.cluster AND p.place = s.place + 1 AND NOT p.flush
        LEFT JOIN near n ON n.seq = p.seq AND list_contains(s.live, n.entry)
        QUALIFY row_number() OVER (PARTITION BY p.seq ORDER BY n.score DESC NULLS LAST, n.entry) = 1)),
played AS MATERIALIZED (SELECT * FROM steps WHERE place > 0)
SELECT p.seq, p.era::BIGINT AS era, p.cluster AS dominant_cluster, p.hit AS cache_hit, p.entry AS entry_seq,
    max(CASE WHEN p.hit THEN w.seq ELSE p.seq END) AS source_seq
FROM played p LEFT JOIN played w ON w.entry = p.entry AND NOT w.hit AND w.seq < p.seq GROUP BY ALL"""


def _responses(flush: str) -> str:
    return f"""{_replayed(flush)}, {_KNN}, {_STRIPPED_DOCS},
lists AS (SELECT seq, string_agg({_HIT}, '|' ORDER BY id) AS hits FROM
    (SELECT b.seq, row_number() OVER (PARTITION BY b.seq ORDER BY b.score DESC, b.doc_id) AS id, category, score, text
     FROM pairs b LEFT JOIN docs USING (doc_id))
    WHERE id <= seq % 3 + 1 GROUP BY seq)
SELECT p.seq, 'query ' || p.seq AS query, hit AS cache_hit,
    CASE WHEN hit THEN 'query ' || source END AS matched_query,
    CASE WHEN hit THEN {_round('score', 4)} END AS similarity_score,
    cluster AS dominant_cluster, hits
FROM played p LEFT JOIN lists ON lists.seq = p.source"""


_STEPS = ", ".join(f"({t}::DOUBLE)" for t in SWEEP_THRESHOLDS)
_ROOT_PATH = (
    "CASE WHEN doc_id % 7 = 3 THEN 'root/' || doc_id ELSE 'root/' || source || '/' || doc_id "
    "|| CASE WHEN doc_id % 5 = 1 THEN '/part' ELSE '' END END"
)


def oracle_sql() -> dict[str, str]:
    return {
        "article_paths": f"""
SELECT path, split_part(path, '/', 2) AS category, split_part(path, '/', 3) AS filename,
    split_part(path, '/', 2) || '/' || split_part(path, '/', 3) AS doc_id
FROM (SELECT {_ROOT_PATH} AS path FROM documents) WHERE len(string_split(path, '/')) >= 3""",
        "decode_articles": f"SELECT doc_id, {_BYTES} AS text FROM documents",
        "header_strip": f"WITH {_RAW}, {_BODY} SELECT doc_seq, {_join('kept')} AS body FROM body",
        "quote_sig_strip": f"""WITH {_RAW}, split AS (SELECT *, {_lines('text')} AS ls FROM raw)
SELECT doc_seq, {_join(_without_quotes('ls'))} AS body FROM split""",
        "whitespace": f"WITH {_RAW} SELECT doc_seq, {_normal('text')} AS body FROM raw",
        "clean_articles": f"WITH {_CLEAN} SELECT doc_seq, doc_id, category, text FROM clean",
        "token_counts": f"SELECT doc_id, {_TOKENS}::INTEGER AS tokens FROM documents",
        "token_filter": f"SELECT doc_id FROM documents WHERE {_TOKENS} >= 50",
        "fingerprints": "SELECT doc_id, md5(substr(text, 1, 200)) AS fingerprint FROM documents",
        "dedup_first": """SELECT doc_id, text FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
        "usable_corpus": f"WITH {_USABLE} SELECT doc_seq, doc_id, category, text FROM usable",
        "load_report": f"""WITH {_USABLE}, counted AS (SELECT
    (SELECT count(*) FROM raw) AS files, (SELECT count(*) FROM usable) AS kept,
    (SELECT count(*) FROM clean WHERE {_TOKENS} < 50) AS too_short,
    (SELECT count(DISTINCT md5(substr(text, 1, 200))) FROM usable) AS openings)
SELECT files, kept, too_short, files - kept - too_short AS duplicates, kept - openings AS opening_alike FROM counted""",
        "first_documents": f"WITH {_USABLE} SELECT doc_seq, doc_id FROM usable ORDER BY doc_seq LIMIT 500",
        "corpus_positions": f"""WITH {_USABLE}
SELECT doc_seq, doc_id, row_number() OVER (ORDER BY doc_seq) - 1 AS doc_index FROM usable""",
        "articles_from_archives": f"""
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, source || '/' || doc_id AS doc_id,
    source AS category, {_BYTES} AS text FROM documents""",
        "vector_collection": """
SELECT vec_id AS doc_id, source AS category, row_number() OVER (ORDER BY vec_id) - 1 AS doc_index, 1.0::DOUBLE AS norm
FROM embeddings LEFT JOIN documents ON vec_id = doc_id""",
        "build_reuse": f"""WITH {_USABLE}
SELECT run::INTEGER AS run, stage, run = 1 OR (run = 3 AND stage = 'index') OR (run = 4 AND stage = 'cluster') AS ran,
  (SELECT count(*) FROM usable) AS n_docs
FROM range(1, 5) AS runs(run), (VALUES ('index'), ('cluster')) AS stages(stage)""",
        "build_tables": f"""WITH {_USABLE}
SELECT doc_id, category, row_number() OVER (ORDER BY doc_seq) - 1 AS doc_index, 4 AS n_clusters FROM usable""",
        "collection_count": "SELECT count(*) AS n FROM embeddings",
        "weighted_embed": f"""
WITH texts AS (SELECT *, row_number() OVER () AS row FROM (
    SELECT 'd' || doc_id AS id, text, true AS counted FROM documents
    UNION ALL SELECT 'c-' || conv_id || '-' || turn, text, false FROM conversations)),
words AS (SELECT id, row, counted, unnest(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+')) AS word FROM texts),
cells AS MATERIALIZED (SELECT id, row, counted, (('0x' || substr(md5(word), 1, 8))::BIGINT % 384)::INTEGER AS bucket, count(*) AS n
    FROM words GROUP BY ALL),
weights AS (SELECT bucket, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) FILTER (WHERE counted) + 1.0)) AS weight
    FROM cells GROUP BY bucket),
weighted AS (SELECT id, row, bucket, n * weight AS x FROM cells JOIN weights USING (bucket))
SELECT id, bucket, {_round('x / sqrt(sum(x * x) OVER (PARTITION BY row))', 6)} AS weight FROM weighted WHERE x <> 0""",
        "l2_normalize": f"""WITH {_VECTORS}, scaled AS (SELECT vec_id, pos, x * (vec_id % 7) AS x FROM cells),
norms AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM scaled GROUP BY vec_id)
SELECT vec_id, (pos - 1)::INTEGER AS pos, {_round('CASE WHEN n > 0 THEN x / n ELSE 0.0 END', 6)} AS value
FROM scaled JOIN norms USING (vec_id)""",
        "cosine_pairs": f"""WITH {_VECTORS}
SELECT vec_id, {_round('list_dot_product(v, c) / sqrt(list_dot_product(c, c))', 4)} AS cosine
FROM vecs JOIN centres ON cluster = label""",
        "knn_top5": f"""WITH {_VECTORS}, {_KNN}
SELECT seq, doc_id, id::INTEGER AS id, {_round('score', 4)} AS similarity FROM best WHERE id <= {TOP_N}""",
        "knn_blocked": f"""WITH {_VECTORS}, {_KNN}
SELECT seq, doc_id, id::INTEGER AS id, {_round('score', 4)} AS similarity FROM best WHERE id <= {TOP_N}""",
        "knn_certified": f"""WITH {_VECTORS}, {_KNN}
SELECT seq, doc_id, id::INTEGER AS id, {_round('score', 4)} AS similarity FROM best WHERE id <= {TOP_N}""",
        "knn_pruned": f"""WITH {_VECTORS}, {_FORWARD},
probes AS (SELECT vec_id, cluster FROM u
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) <= {NPROBE}),
best AS (SELECT a.vec_id AS seq, b.vec_id AS doc_id, {_SCORE} AS score,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {_SCORE} DESC, b.vec_id) AS id
    FROM vecs a JOIN probes USING (vec_id) JOIN dom USING (cluster) JOIN vecs b ON b.vec_id = dom.vec_id)
SELECT seq, doc_id, id::INTEGER AS id, {_round('score', 4)} AS similarity FROM best WHERE id <= {TOP_N}""",
        "knn_result_list": f"""WITH {_VECTORS}, {_KNN}, {_STRIPPED_DOCS}
SELECT seq, string_agg({_HIT}, '|' ORDER BY id) AS hits FROM
    (SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY score DESC, doc_id) AS id, category, score, text
     FROM pairs LEFT JOIN docs USING (doc_id)) WHERE id <= {TOP_N} GROUP BY seq""",
        "fuzzy_memberships": f"""WITH {_VECTORS}, {_FORWARD}
SELECT vec_id::VARCHAR AS doc_id, cluster, {_round('u', 6)} AS membership FROM u""",
        "dominant_cluster": f"""WITH {_VECTORS}, {_FORWARD}
SELECT vec_id::VARCHAR AS doc_id, cluster AS dominant_cluster FROM dom""",
        "membership_entropy": f"""WITH {_VECTORS}, {_FORWARD}
SELECT vec_id::VARCHAR AS doc_id, {_round('-sum(greatest(least(u, 1.0), 1e-10) * ln(greatest(least(u, 1.0), 1e-10)))', 6)} AS entropy
FROM u GROUP BY vec_id""",
        "cluster_quality": f"""WITH {_VECTORS}, {_FORWARD}
SELECT (SELECT count(*) FROM vecs) AS n_docs, (SELECT count(DISTINCT cluster) FROM dom) AS n_labels,
    round(sum(u * u) / (SELECT count(*) FROM vecs), 6) AS fpc FROM u""",
        "top_docs": f"""WITH {_VECTORS}, {_FORWARD}, ranked AS (SELECT cluster,
    row_number() OVER (PARTITION BY cluster ORDER BY u DESC, vec_id::VARCHAR) AS rank, vec_id, u FROM u)
SELECT cluster, rank::INTEGER AS rank, vec_id::VARCHAR AS doc_id, label::VARCHAR AS category,
    round(u, 6) AS membership FROM ranked JOIN vecs USING (vec_id) WHERE rank <= 10""",
        "boundary_docs": _boundary(20, 6, True),
        "boundary_report": _boundary(3, 3, False),
        "silhouette_cosine": f"""WITH {_VECTORS}, labelings AS (SELECT 10 AS k, label, vec_id FROM vecs),
{_silhouette('labelings')} SELECT k, {_round('silhouette', 6)} AS silhouette FROM scores""",
        "silhouette_by_k": f"""WITH {_VECTORS}, {_LABELINGS},
{_silhouette('labelings')} SELECT k, {_round('silhouette', 6)} AS silhouette FROM scores""",
        "select_k": f"""WITH {_VECTORS}, {_LABELINGS}, {_silhouette('labelings')}
SELECT k AS best_k, {_round('silhouette', 6)} AS silhouette, greatest(5, least(8, k)) AS selected_k FROM scores
WHERE silhouette > -1 ORDER BY round(silhouette, 6) DESC, k LIMIT 1""",
        "fcm_pass": f"""WITH {_VECTORS}, {_FORWARD}
SELECT cluster, (pos - 1)::INTEGER AS pos, {_round('sum(u * u * x) / sum(u * u)', 6)} AS value
FROM u JOIN cells USING (vec_id) GROUP BY cluster, pos""",
        "sample_rows": f"SELECT vec_id FROM embeddings ORDER BY md5('42:' || vec_id), vec_id LIMIT {SAMPLED}",
        "stratified_sample": f"""WITH docs AS (SELECT doc_id, concat_ws('/', source, lang) AS stratum FROM documents),
sizes AS (SELECT stratum, count(*) AS size, sum(count(*)) OVER () AS total FROM docs GROUP BY stratum),
shares AS (SELECT *, least({SAMPLED}, total) AS wanted FROM sizes),
dealt AS (SELECT stratum, size * wanted // total AS share, wanted,
  row_number() OVER (ORDER BY size * wanted % total DESC, stratum) AS turn FROM shares),
seats AS (SELECT stratum, share + (turn <= wanted - sum(share) OVER ())::INTEGER AS seats FROM dealt),
places AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || doc_id), doc_id) AS place FROM docs)
SELECT doc_id, stratum FROM places JOIN seats USING (stratum) WHERE place <= seats""",
        "cluster_artifact": f"""WITH {_VECTORS}
SELECT cluster, (pos - 1)::INTEGER AS pos, {_round('value', 6)} AS value, (SELECT count(*) FROM vecs) AS n_docs
FROM (SELECT cluster, unnest(c) AS value, generate_subscripts(c, 1) AS pos FROM centres)""",
        "cluster_summary": f"""WITH {_VECTORS}, {_FORWARD},
ranked AS (SELECT cluster, vec_id::VARCHAR AS doc_id,
    row_number() OVER (PARTITION BY cluster ORDER BY u DESC, vec_id::VARCHAR) AS rank FROM u),
tops AS (SELECT cluster, string_agg(doc_id, ',' ORDER BY rank) AS docs FROM ranked WHERE rank <= 10 GROUP BY cluster),
edges AS (SELECT vec_id::VARCHAR AS doc_id, -sum(u * ln(u)) AS e FROM u GROUP BY vec_id
    ORDER BY e DESC, doc_id LIMIT 20)
SELECT 10 AS n_clusters, (SELECT count(*) FROM vecs) AS n_docs, 2.0::DOUBLE AS fuzziness_m, 12 AS n_scores,
    (SELECT string_agg(docs, '|' ORDER BY cluster) FROM tops) AS top_docs,
    (SELECT string_agg(doc_id, ',' ORDER BY e DESC, doc_id) FROM edges) AS boundary""",
        "cluster_assignment": f"""WITH {_VECTORS}, {_REVERSED}
SELECT vec_id, rdom.cluster AS dominant_cluster, round(ru.u, 6) AS membership
FROM rdom JOIN ru USING (vec_id, cluster)""",
        "cache_lookup": f"""{_LOOKED_UP}
SELECT seq, dominant_cluster, entry_seq, {_round('score', 4)} AS score,
    coalesce(score >= threshold, false) AS cache_hit FROM found""",
        "cache_answers": f"""{_LOOKED_UP}
SELECT seq, 'query ' || entry_seq AS matched_query, {_round('score', 4)} AS similarity_score,
    '1:' || label || ':1.0000:' || length(entry_seq::VARCHAR) AS hits
FROM found JOIN vecs ON vec_id = entry_seq WHERE score >= threshold""",
        "cache_stats": f"""{_LOOKED_UP}, counted AS (SELECT count(*) FILTER (WHERE score >= threshold) AS hit_count,
    count(*) FILTER (WHERE NOT coalesce(score >= threshold, false)) AS miss_count FROM found)
SELECT (SELECT count(*) FROM vecs) AS total_entries, hit_count, miss_count,
    round(hit_count / (hit_count + miss_count), 4) AS hit_rate, {CACHE_THRESHOLD}::DOUBLE AS threshold FROM counted""",
        "cache_snapshot": f"""SELECT count(*) AS total_entries, 5::BIGINT AS hit_count, 8::BIGINT AS miss_count,
    round(5 / 13.0, 4)::DOUBLE AS hit_rate, {CACHE_THRESHOLD}::DOUBLE AS threshold FROM embeddings""",
        "cache_replay": f"""{_replayed('false')}
SELECT seq, cluster AS dominant_cluster, hit AS cache_hit, source AS source_seq FROM played""",
        "cache_replay_chunked": _REPEATED,
        "cache_replay_flushed": f"""{_replayed(_FLUSH)}
SELECT seq, era, cluster AS dominant_cluster, hit AS cache_hit, source AS source_seq FROM played""",
        "stream_replay_keyed": f"""{_replayed(_FLUSH)}
SELECT seq, era, cluster AS dominant_cluster, hit AS cache_hit, source AS source_seq FROM played""",
        "replay_stats": f"""{_replayed(_FLUSH)}, counted AS (SELECT count(*) FILTER (WHERE hit) AS hit_count,
    count(*) FILTER (WHERE NOT hit) AS miss_count FROM played WHERE era = (SELECT max(era) FROM log))
SELECT miss_count AS total_entries, hit_count, miss_count,
    round(hit_count / (hit_count + miss_count), 4) AS hit_rate, {REPLAY_THRESHOLD}::DOUBLE AS threshold FROM counted""",
        "replay_responses": _responses("false"),
        "stream_replay": _responses(_FLUSH),
        "cache_inserts": f"""WITH RECURSIVE {_VECTORS}, {_FORWARD}, {_REVERSED},
{_played('false', CACHE_THRESHOLD, old=True)}
SELECT item AS seq, 'old ' || (item + 1000000) AS query, cluster AS dominant_cluster FROM items WHERE item < 0
UNION ALL SELECT seq, 'query ' || seq, cluster FROM played WHERE NOT hit""",
        "validate_requests": """
WITH turns AS (SELECT conv_id, turn, CASE WHEN turn = 2 THEN '' ELSE text END AS query,
    CASE WHEN role = 'user' THEN turn * 0.3 - 0.1 END AS threshold,
    CASE WHEN conv_id % 3 <> 0 THEN conv_id % 24 ELSE 5 END AS n FROM conversations)
SELECT conv_id, turn, n::INTEGER AS n_results, CASE
    WHEN query IS NULL OR query = '' THEN 'query: at least 1 character'
    WHEN threshold < 0 OR threshold > 1 THEN 'threshold: between 0 and 1'
    WHEN n < 1 OR n > 20 THEN 'n_results: between 1 and 20' END AS reason FROM turns""",
        "health": """SELECT 'healthy' AS status, (SELECT count(*) FROM documents) AS indexed_documents,
    (SELECT count(DISTINCT label) FROM embeddings) AS n_clusters, (SELECT count(*) FROM embeddings) AS cached_queries""",
        "similarity_report": f"""WITH {_VECTORS}
SELECT a.vec_id AS seq, 'query ' || a.vec_id AS query, {_round('list_dot_product(a.v, b.v)', 3)} AS similarity
FROM vecs a, (SELECT v FROM vecs ORDER BY vec_id LIMIT 1) b""",
        "case_report": f"""WITH {_VECTORS}
SELECT 'case ' || label AS label, a.vec_id AS seq, {_round('list_dot_product(list_reverse(a.v), b.v)', 3)} AS similarity
FROM vecs a, (SELECT v FROM vecs ORDER BY vec_id LIMIT 1) b""",
        "base_query_sweep": f"""WITH {_VECTORS}, {_FORWARD},
base AS (SELECT v, cluster FROM vecs JOIN dom USING (vec_id) ORDER BY vec_id LIMIT 1)
SELECT a.vec_id AS seq, t AS threshold, CASE WHEN dom.cluster = b.cluster AND {_SCORE} >= t THEN 'HIT' ELSE 'MISS' END AS outcome
FROM vecs a JOIN dom USING (vec_id), base b, (VALUES {_STEPS}) s(t)""",
        "threshold_sweep": f"""{_LOOKED_UP}
SELECT seq, t AS threshold, CASE WHEN score >= t THEN 'HIT' ELSE 'MISS' END AS outcome
FROM found, (VALUES {_STEPS}) s(t)""",
    }


def _boundary(docs: int, digits: int, with_entropy: bool) -> str:
    entropy = "round(e, 6) AS entropy, " if with_entropy else ""
    return f"""WITH {_VECTORS}, {_FORWARD},
edges AS (SELECT vec_id, -sum(greatest(least(u, 1.0), 1e-10) * ln(greatest(least(u, 1.0), 1e-10))) AS e
    FROM u GROUP BY vec_id ORDER BY e DESC, vec_id::VARCHAR LIMIT {docs}),
largest AS (SELECT vec_id, cluster, u FROM u
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY u DESC, cluster) <= 5)
SELECT vec_id::VARCHAR AS doc_id, label::VARCHAR AS category, {entropy}cluster::VARCHAR AS cluster,
    round(u, {digits}) AS membership FROM edges JOIN largest USING (vec_id) JOIN vecs USING (vec_id)"""
