"""DuckDB SQL for the operators that SQL can express, with its constants written out."""

CHAT = r"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), marked AS (
    SELECT *, contains(text, '[INST]') OR contains(text, '[/INST]') OR contains(text, '<s>') OR contains(text, '</s>')
        OR contains(text, '[ROLE]') OR contains(text, '[/ROLE]') OR contains(text, '[:]') OR regexp_matches(text, '(?s)\\.') AS hard
    FROM rows_
), lengths AS (
    SELECT *, length(text) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 16 + length(role) END
        + CASE WHEN hard THEN (length(replace(text, '\', '\\')) - length(text))
            + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7
            + (length(text) - length(replace(text, '<s>', ''))) // 3 + (length(text) - length(replace(text, '</s>', ''))) // 4
            + (length(text) - length(replace(text, '[ROLE]', ''))) // 6 + (length(text) - length(replace(text, '[/ROLE]', ''))) // 7
            + (length(text) - length(replace(text, '[:]', ''))) // 3 ELSE 0 END AS n
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(n) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""

EMBEDDINGS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: str, pattern: str, group: int, least: int, rank: int) -> str:
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, value, finish - length(whole) AS start, finish FROM (
        SELECT doc_id, whole[i] AS whole, value[i] AS value,
            list_sum([length(x) FOR x IN gaps[1:i]]) + list_sum([length(x) FOR x IN whole[1:i]]) AS finish
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS value,
                string_split_regex(text, '{pattern}') AS gaps FROM texts), unnest(range(1, len(whole) + 1)) r(i)
    ) WHERE length(value) >= {least}"""


SECRETS = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({_matches('assign', _ASSIGN, 2, 6, 1)} UNION ALL {_matches('access', 'AKIA[A-Z0-9]+', 0, 20, 2)}
    UNION ALL {_matches('hex', '[0-9a-f]+', 0, 24, 3)}),
held AS (
    SELECT value, count(DISTINCT coalesce(source, '')) AS owners, count(DISTINCT coalesce(source, '') || ' ' || doc_id) AS repositories
    FROM base JOIN texts USING (doc_id) GROUP BY value
), looks AS (
    SELECT base.*, owners, repositories, len(list_distinct(string_split(value, ''))) AS different,
        length(value) >= 16 AND different >= 8 AND regexp_matches(value, '[0-9]')
            AND NOT regexp_matches(lower(value), 'example|sample|placeholder|change_?-?me|your[-_.]|dummy|redacted|xxxx')
            OR regexp_full_match(value, 'AKIA[A-Z0-9]{{16,}}') AS strong
    FROM base JOIN held USING (value)
), judged AS (
    SELECT *, CASE WHEN owners >= 3 THEN 'example' WHEN strong THEN 'live' WHEN repositories >= 20 THEN 'example'
        WHEN kind = 'assign' AND different >= 4 THEN 'live' END AS verdict FROM looks
), added AS (
    SELECT DISTINCT doc_id, verdict AS kind, CASE verdict WHEN 'live' THEN 4 ELSE 5 END AS rank, finish - length(value) AS start, finish
    FROM judged WHERE verdict IS NOT NULL
),
all_ AS (SELECT doc_id, kind, rank, start, finish FROM base UNION ALL SELECT doc_id, kind, rank, start, finish FROM added),
spans AS (
    SELECT doc_id, string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank, finish) AS spans,
        string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank, finish) FILTER (rank <= 3) AS base,
        {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ('assign', 'access', 'hex', 'live', 'example'))}
    FROM all_ GROUP BY doc_id
)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in ('assign', 'access', 'hex'))},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts LEFT JOIN spans USING (doc_id)
"""

_WORDS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

#: Every window that shares a shingle with an item of its size, compared exactly.
DECONTAMINATION = f"""
WITH texts AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
item_grams AS MATERIALIZED (
    SELECT item_id, n, k, g, count(*) AS c FROM (
        SELECT item_id, n, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM items, unnest(range(1, n - k + 2)) r(i)) GROUP BY ALL),
grams AS MATERIALIZED (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM texts, (SELECT DISTINCT k FROM items), unnest(range(1, len(w) - k + 2)) r(i)),
starts AS (
    SELECT DISTINCT doc_id, item_id, n, k, s FROM (
        SELECT doc_id, item_id, n, k, unnest(range(greatest(1, i - n + k), i + 1)) AS s FROM grams JOIN item_grams USING (k, g))
    JOIN texts USING (doc_id) WHERE s + n - 1 <= len(w)),
windows AS (
    SELECT doc_id, item_id, n, k, s, g, count(*) AS c FROM starts JOIN grams USING (doc_id, k) WHERE i BETWEEN s AND s + n - k GROUP BY ALL),
compared AS (
    SELECT doc_id, item_id, n, s, sum(least(w.c, i.c)) AS common, any_value(n - k + 1) AS m
    FROM windows w JOIN item_grams i USING (item_id, n, k, g) GROUP BY ALL)
SELECT doc_id, item_id, common / (2 * m - common) AS similarity, s - 1 AS start_word, n AS n_words
FROM compared WHERE common / (2 * m - common) >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""

TOP_K = """
WITH usable AS (
    SELECT vec_id, row_number() OVER () AS row, [CAST(floor(64 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.row, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

#: Documents count by the set of filters they fail; every order and step then looks at each set.
FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
    SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, count(*) AS n,
        concat(CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
            CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
            CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first THEN 'E' END) AS fails
    FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM words) d
    LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
    GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS f, filter_order[:step - 1] AS before FROM orders, unnest(range(1, 6)) r(step)
), judged AS (
    SELECT *, contains(fails, f) AS failing, length(translate(before, fails, '')) < length(before) AS gone FROM sets, steps
), counted AS (
    SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {
    "op2_secret_scans": SECRETS,
    "op6_embedding_near_dedup": EMBEDDINGS,
    "op8_decontamination": DECONTAMINATION,
    "op9_chat_formatting": CHAT,
    "op11_exact_top_k": TOP_K,
    "op13_filter_audit": FILTER_AUDIT,
}
