"""SQL that DuckDB runs over the same tables, one statement per checkable query.

Written independently of the Spark side where there is a choice: sentences by
masking, ROUGE by n-gram joins, TextRank over explicit sentence pairs.
"""

from __future__ import annotations

from checks import fixed as P
from checks.stems import stems
from pithy.functions.stopwords import ENGLISH


def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


WS = P.WS
WORD = q(f"[^{P.WS_RANGES}]+")


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q('^' + WS + '+')}, ''), {q(WS + '+$')}, '')"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {WORD}))"


def normal(x: str) -> str:
    x = f"regexp_replace({x}, {q(P.CONTROL)}, ' ', 'g')"
    for flags, pattern in P.BOILERPLATE:
        x = f"regexp_replace({x}, {q(f'(?{flags})' + pattern)}, '', 'g')"
    return f"trim(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'))"


def drop_elements(x: str, names: tuple[str, ...]) -> str:
    elements = "|".join(rf"<{n}\b[^>]*>.*?(?:</{n}\s*>|\z)" for n in names)
    return f"regexp_replace({x}, {q(rf'(?is)<!--.*?(?:-->|\z)|{elements}')}, ' ', 'g')"


def visible(x: str) -> str:
    x = strip(f"regexp_replace({x}, {q(f'{WS}*(?:{P.TAG}{WS}*)+')}, ' ', 'g')")
    for name, value in P.ENTITIES:
        x = f"replace({x}, {q(name)}, {q(value)})"
    return x


def sentence_list(x: str) -> str:
    for a in P.ABBREVIATIONS:
        x = f"replace({x}, {q(a)}, {q(a.replace('.', P.DOT_LITERAL))})"
    boundary = q(f"([.!?]){WS}+({P.SENTENCE_OPENER})")
    x = f"string_split(regexp_replace({x}, {boundary}, '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    x = f"list_filter({x}, lambda s: {strip('s')} <> '')"
    return f"list_transform({x}, lambda s: {strip('replace(s, ' + q(P.DOT_LITERAL) + ', ' + q('.') + ')')})"


def effective(requested: str, total: str) -> str:
    return (
        f"CASE WHEN {total} <= 1 THEN 1 ELSE greatest(1, least({requested}, "
        f"greatest(1, CAST(round({total} * 0.6) AS INT)), {total} - 1)) END"
    )


DOCS = f"docs AS MATERIALIZED (SELECT doc_id AS id, source, {normal('text')} AS article FROM documents)"
SENTS = f"{DOCS}, sents AS MATERIALIZED (SELECT id, source, article, {sentence_list('article')} AS s FROM docs)"
RAW = f"""{SENTS}, raw AS MATERIALIZED (
  SELECT id, source, coalesce(array_to_string(s[2:], ' '), '') AS article, coalesce(s[1], '') AS highlights
  FROM sents)"""
CHECKED = f"""{RAW}, checked AS MATERIALIZED (
  SELECT *, CASE WHEN article_words = 0 THEN 'empty_article' WHEN summary_words = 0 THEN 'empty_summary'
                 WHEN article_words < summary_words THEN 'summary_longer_than_article' END AS reject_reason
  FROM (SELECT *, {words('article')} AS article_words, {words('highlights')} AS summary_words FROM raw))"""
PAIRS = f"""{CHECKED}, pairs AS MATERIALIZED (
  SELECT id, source, article, highlights, article_words, summary_words
  FROM checked WHERE reject_reason IS NULL)"""

STOP = "(" + ", ".join(q(w) for w in ENGLISH) + ")"
TOKEN = q(r"[\p{L}\p{N}_]{2,}")


def weights(source: str) -> str:
    """CTEs up to w(id, si, token, tf, df, weight); source(id, s) holds sentence lists."""
    return f"""
sent_rows AS MATERIALIZED (
  SELECT id, len(s) AS n, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS si FROM {source}),
tok AS (SELECT id, n, si, unnest(regexp_extract_all(lower(sentence), {TOKEN})) AS token FROM sent_rows),
tf AS (SELECT id, n, si, token, count(*) AS tf FROM tok WHERE token NOT IN {STOP} GROUP BY ALL),
df AS (SELECT id, token, count(*) AS df FROM tf GROUP BY ALL),
raw_w AS (SELECT id, si, token, tf, df, tf * (ln((1 + n) / (1 + df)) + 1) AS v FROM tf JOIN df USING (id, token)),
len_w AS (SELECT id, si, sqrt(sum(v * v)) AS l FROM raw_w GROUP BY ALL),
w AS MATERIALIZED (SELECT id, si, token, tf, df, v / l AS weight FROM raw_w JOIN len_w USING (id, si))"""


def ranks(source: str) -> str:
    """CTEs up to final(id, si, score): PageRank with per-document stop."""
    return f"""{weights(source)},
edges AS MATERIALIZED (
  SELECT a.id, a.si AS src, b.si AS dst, sum(a.weight * b.weight) AS sim
  FROM w a JOIN w b ON a.id = b.id AND a.token = b.token AND a.si <> b.si GROUP BY ALL),
outs AS (SELECT id, src AS si, sum(sim) AS total FROM edges GROUP BY ALL),
moves AS MATERIALIZED (
  SELECT e.id, e.src, e.dst, e.sim / o.total AS p FROM edges e JOIN outs o ON e.id = o.id AND e.src = o.si),
rank AS (
  SELECT r.id, r.si, CAST(r.n AS DOUBLE) AS n, 1.0::DOUBLE / r.n AS x, 0 AS it, true AS active, o.total IS NULL AS lost
  FROM sent_rows r LEFT JOIN outs o USING (id, si) WHERE r.n > 1
  UNION ALL
  SELECT id, si, n, x, it, sum(abs(x - old)) OVER (PARTITION BY id) >= n * 1e-4 AS active, lost
  FROM (SELECT r.id, r.si, r.n, r.x AS old, r.it + 1 AS it, r.lost,
               0.85 * (coalesce(i.s, 0) + coalesce(d.s, 0) / r.n) + 0.15 / r.n AS x
        FROM rank r
        LEFT JOIN (SELECT m.id, m.dst, sum(k.x * m.p) AS s FROM rank k
                   JOIN moves m ON m.id = k.id AND m.src = k.si WHERE k.active GROUP BY ALL) i
               ON i.id = r.id AND i.dst = r.si
        LEFT JOIN (SELECT id, sum(x) AS s FROM rank WHERE lost AND active GROUP BY ALL) d ON d.id = r.id
        WHERE r.active AND r.it < 200)),
final AS MATERIALIZED (SELECT id, si, arg_max(x, it) AS score FROM rank GROUP BY ALL)"""


def textrank(source: str) -> str:
    """CTEs up to picked(id, summary)."""
    return f"""{ranks(source)},
ordered AS (
  SELECT r.id, r.si, r.sentence, r.n,
         row_number() OVER (PARTITION BY r.id ORDER BY round(f.score, 10) DESC, r.si) AS place
  FROM sent_rows r LEFT JOIN final f USING (id, si)),
picked AS MATERIALIZED (
  SELECT id, string_agg(sentence, ' ' ORDER BY si) AS summary FROM ordered
  WHERE place <= {effective('3', 'n')} GROUP BY id)"""


def lead(s: str) -> str:
    return f"coalesce(array_to_string({s}[:{effective('3', f'len({s})')}], ' '), '')"


# Summaries of both methods over the good pairs.
SUMMARIES = f"""{PAIRS},
psents AS MATERIALIZED (SELECT id, {sentence_list('article')} AS s FROM pairs),
{textrank('psents')},
lead AS (SELECT id, {lead('s')} AS summary FROM psents),
rows_ AS MATERIALIZED (
  SELECT p.id, p.source, p.article_words, p.highlights AS reference_summary, m.method,
         coalesce(CASE m.method WHEN 'lead_3' THEN l.summary ELSE t.summary END, '') AS generated_summary
  FROM pairs p JOIN lead l USING (id) LEFT JOIN picked t USING (id)
  CROSS JOIN (VALUES ('lead_3'), ('textrank')) m(method)),
made AS MATERIALIZED (
  SELECT *, {words('generated_summary')} AS summary_length,
         CASE WHEN article_words > 0 THEN {words('generated_summary')} / greatest(1, article_words) END AS ratio,
         regexp_extract_all(lower(reference_summary), '[a-z0-9]+') AS rt,
         regexp_extract_all(lower(generated_summary), '[a-z0-9]+') AS ct
  FROM rows_)"""


# The same with the tokens' stems.
STEMMED = SUMMARIES.replace("made AS MATERIALIZED (", "unstemmed AS MATERIALIZED (") + f""",
vocabulary AS (SELECT DISTINCT unnest(rt || ct) AS o FROM unstemmed), {stems('vocabulary')},
places AS (
  SELECT id, method, 'r' AS side, unnest(range(1, len(rt) + 1)) AS i, unnest(rt) AS o FROM unstemmed
  UNION ALL SELECT id, method, 'c', unnest(range(1, len(ct) + 1)), unnest(ct) FROM unstemmed),
lists AS (SELECT id, method, side, list(stem ORDER BY i) AS l FROM places JOIN stems USING (o) GROUP BY ALL),
made AS MATERIALIZED (
  SELECT u.* EXCLUDE (rt, ct), coalesce(r.l, []) AS rt, coalesce(c.l, []) AS ct FROM unstemmed u
  LEFT JOIN lists r ON r.id = u.id AND r.method = u.method AND r.side = 'r'
  LEFT JOIN lists c ON c.id = u.id AND c.method = u.method AND c.side = 'c')"""


def prf(hits: str, n_ref: str, n_cand: str) -> str:
    p, r = f"({hits} / greatest(1, {n_cand}))", f"({hits} / greatest(1, {n_ref}))"
    return f"{p} AS precision, {r} AS recall, CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0 END AS f1"


def grams(tokens: str, n: int) -> str:
    if n == 1:
        return f"unnest({tokens})"
    return f"unnest(list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"


def rouge_n(name: str, n: int, source: str = "made", key: str = "id, method") -> str:
    """CTE name(id, method, precision, recall, f1) by n-gram counts."""
    size = "len({})" if n == 1 else "greatest(0, len({}) - 1)"
    return f"""
{name}_g AS (
  SELECT {key}, g, sum(r) AS r, sum(c) AS c FROM (
    SELECT {key}, {grams('rt', n)} AS g, 1 AS r, 0 AS c FROM {source}
    UNION ALL SELECT {key}, {grams('ct', n)} AS g, 0 AS r, 1 AS c FROM {source}) GROUP BY ALL),
{name}_h AS (SELECT {key}, CAST(sum(least(r, c)) AS DOUBLE) AS h FROM {name}_g GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT {key}, {prf('coalesce(h, 0)', size.format('rt'), size.format('ct'))}
  FROM {source} LEFT JOIN {name}_h USING ({key}))"""


# LCS row by row: the next row is the running maximum of "as above" and "match".
MATCHES = """list_transform(ct, lambda t: list_transform(rt, lambda u: CASE WHEN u = t THEN 1 ELSE 0 END))"""
STEP = """list_transform(row, lambda v, i: greatest(v, CASE WHEN hit[i] = 1 THEN
          (CASE WHEN i > 1 THEN row[i - 1] ELSE 0 END) + 1 ELSE 0 END))"""
RUNNING = f"""list_reduce(list_transform({STEP}, lambda v: [v]),
          lambda a, b: list_append(a, greatest(a[len(a)], b[1])))"""
LCS = f"""
lcs AS MATERIALIZED (
  SELECT id, method, len(rt) AS nr, len(ct) AS nc, CASE WHEN len(rt) = 0 OR len(ct) = 0 THEN 0 ELSE
    list_last(list_reduce(list_prepend(list_transform(rt, lambda u: 0), {MATCHES}), lambda row, hit: {RUNNING})) END AS h
  FROM made),
rl AS MATERIALIZED (SELECT id, method, {prf('CAST(h AS DOUBLE)', 'nr', 'nc')} FROM lcs)"""

R1, R2 = rouge_n("r1", 1), rouge_n("r2", 2)


def dist(value: str) -> str:
    return f"""count({value}) AS count, round(avg({value}), 6) AS mean, round(median({value}), 6) AS median,
  round(stddev_samp({value}), 6) AS std, round(min({value}), 6) AS min,
  round(quantile_cont({value}, 0.25), 6) AS p25, round(quantile_cont({value}, 0.75), 6) AS p75,
  round(max({value}), 6) AS max"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def random_split(source: str) -> str:
    return f"""
hashed AS (SELECT *, md5(id || ':42') AS h, count(*) OVER () AS n FROM {source}),
parted AS MATERIALIZED (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY h) <= ceil(0.25 * n) THEN 'test' ELSE 'train' END AS part FROM hashed)"""


LABELLED = """labelled AS (
  SELECT d.doc_id AS id, CASE WHEN l.toxic = 1 THEN 'other' WHEN l.quality = 0 THEN ' Dev '
         WHEN l.quality = 1 THEN 'TEST' ELSE 'train' END AS split
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

BAND = """CASE WHEN article_words < 100 THEN '000-099' WHEN article_words < 250 THEN '100-249'
  WHEN article_words < 500 THEN '250-499' ELSE '500+' END"""

SUMMARY = f"""summary AS (
  SELECT method, count(*) AS n_examples, avg(r1.f1) AS rouge1, avg(r2.f1) AS rouge2,
         avg(summary_length) AS mean_summary_length, coalesce(avg(ratio), 0) AS mean_compression_ratio
  FROM made JOIN r1 USING (id, method) JOIN r2 USING (id, method) GROUP BY method)"""


def _paragraphs(region: str) -> str:
    closers = "p|div|article|section|main|body|html|ul|ol|table|h[1-6]|blockquote|pre|figure"
    cut = rf"(?is)^(.*?)(?:</?(?:{closers})\b|\z)"
    chunks = f"string_split_regex(regexp_replace({region}, '(?i)<p(?:[\\s/][^>]*)?>', chr(1), 'g'), chr(1))"
    return f"list_transform({chunks}[2:], lambda c: {visible(f'regexp_extract(c, {q(cut)}, 1)')})"


def _region(name: str) -> str:
    return f"regexp_extract(m, {q(rf'(?is)<{name}\b[^>]*>(.*?)(?:</{name}\s*>|\z)')}, 1)"


CHROME = "|".join(P.CHROME_PHRASES)
PAGES = f"""
marked AS MATERIALIZED (SELECT page_id, url, {drop_elements('html', P.PAGE_DROPPED)} AS m FROM pages),
parts AS (
  SELECT page_id, url, CASE WHEN {_region('title')} <> '' THEN {_region('title')} ELSE {_region('h1')} END AS t,
         CASE WHEN regexp_matches({_region('article')}, '(?i)<p[\\s>/]') THEN {_region('article')}
              ELSE {_region('body')} END AS b FROM marked),
paras AS (SELECT page_id, url, {visible('t')} AS title, {_paragraphs('b')} AS ps FROM parts),
bodies AS (
  SELECT page_id, url, title, {normal(f'''coalesce(array_to_string(list_filter(ps, lambda p: {words('p')} >= 8
    AND NOT regexp_matches(lower(p), {q(CHROME)}) AND NOT regexp_matches(lower(p), {q(P.CHROME_OPENING)})), ' '), '')''')} AS article
  FROM paras),
parsed AS MATERIALIZED (
  SELECT page_id, url, title, article, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS domain,
         CASE WHEN {words('article')} < 30 THEN 'too_short' ELSE 'ok' END AS status
  FROM bodies),
ok_pages AS MATERIALIZED (
  SELECT page_id, url, title, article, domain, status, CASE WHEN status = 'ok' THEN {sentence_list('article')} ELSE [] END AS s
  FROM parsed)"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # text
    sql["normalize_text"] = with_(DOCS) + "SELECT id, article FROM docs"
    sql["page_text"] = (
        f"SELECT page_id, CASE WHEN html LIKE '%<%' THEN {visible(drop_elements('html', P.TEXT_DROPPED))} "
        "ELSE html END AS text FROM pages"
    )
    sql["clean_cells"] = f"SELECT conv_id, turn, {strip(chr(34) + 'text' + chr(34))} AS text FROM conversations"
    sql["split_sentences"] = with_(SENTS) + (
        "SELECT id, generate_subscripts(s, 1) - 1 AS si, unnest(s) AS sentence FROM sents"
    )
    sql["word_counts"] = with_(SENTS) + (
        f"SELECT id, {words('article')} AS words, len(s) AS n_sentences, len(s) <= 2 AS short_input FROM sents"
    )
    sql["effective_n"] = with_(SENTS) + "SELECT id, len(s) AS total, " + ", ".join(
        f"{effective(str(n), 'len(s)')} AS n{n}" for n in (0, 1, 3, 5, 10)
    ) + " FROM sents"

    # quality
    stats = ", ".join(
        f"{f'round(avg({side}_words), 6)' if stat == 'mean' else f'CAST({stat}({side}_words) AS DOUBLE)'} AS {side}_{stat}"
        for side in ("article", "summary") for stat in ("mean", "median", "min", "max")
    )
    reasons = ", ".join(
        f"count(*) FILTER (reject_reason = '{r}') AS {r}_rows"
        for r in ("empty_article", "empty_summary", "summary_longer_than_article")
    )
    dups = "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT article, highlights FROM raw))"
    sql["validation_profile"] = with_(CHECKED) + f"""
      SELECT count(*) AS rows, 'id,source,article,highlights' AS columns, count(DISTINCT source) AS sources,
             {dups} AS duplicate_rows, {reasons}, {stats} FROM checked"""
    sql["row_quarantine"] = with_(CHECKED) + (
        "SELECT id, article_words, summary_words, reject_reason FROM checked"
    )
    sql["valid_rows"] = with_(PAIRS) + "SELECT id, highlights FROM pairs"
    sql["first_offenders"] = with_(CHECKED) + (
        "SELECT id FROM checked WHERE reject_reason = 'empty_article' ORDER BY id LIMIT 5"
    )
    sql["duplicate_count"] = with_(RAW) + f"SELECT {dups} AS duplicate_rows"
    sql["snapshot_counts"] = with_(CHECKED) + f"""
      SELECT count(*) AS rows, count(*) FILTER (article_words = 0) AS empty_articles,
             count(*) FILTER (summary_words = 0) AS empty_references, {dups} AS duplicate_pairs FROM checked"""
    sql["distinct_sources"] = "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL"
    sql["prepared_pairs"] = f"""
      SELECT page_id AS id, {normal(visible(drop_elements('html', P.TEXT_DROPPED)))} AS article,
             {normal('url')} AS highlights FROM pages"""
    sql["dedup_first"] = f"""
      WITH keyed AS (SELECT doc_id AS id, text, lower({strip('text')}) AS k FROM documents)
      SELECT id, length(text) AS chars FROM keyed WHERE k <> ''
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1"""

    # splits
    sql["hash_split"] = with_(
        "docs AS (SELECT doc_id AS id FROM documents)", random_split("docs")
    ) + "SELECT id, part AS split FROM parted"
    sql["bucket_split"] = """
      SELECT doc_id AS id, CASE WHEN CAST('0x' || md5(doc_id || ':42')[1:12] AS BIGINT) / 281474976710656.0 < 0.25
                                THEN 'test' ELSE 'train' END AS split FROM documents"""
    sql["explicit_split"] = with_(LABELLED) + """
      SELECT id, CASE WHEN lower(trim(split)) IN ('validation', 'val', 'dev') THEN 'validation'
                      ELSE lower(trim(split)) END AS split
      FROM labelled WHERE lower(trim(split)) IN ('train', 'test', 'validation', 'val', 'dev')"""
    sql["split_fallback"] = sql["hash_split"]
    sql["split_skew"] = with_(PAIRS, random_split("pairs")) + """
      SELECT part AS split, count(*) AS rows, round(avg(article_words), 6) AS mean_article_words,
             round(avg(summary_words), 6) AS mean_summary_words,
             round(avg(round(summary_words / greatest(1, article_words), 6)), 6) AS mean_reference_compression
      FROM parted GROUP BY part"""
    sql["capped_rows"] = with_(RAW) + "SELECT id, highlights FROM raw ORDER BY md5(id || ':42'), id LIMIT 50"

    # summaries
    sql["lead_n"] = with_(SENTS) + (
        f"SELECT id, 'lead_3' AS method, {lead('s')} AS summary, len(s) <= 2 AS short_input FROM sents"
    )
    sql["tfidf_weights"] = with_(SENTS, weights("sents")) + (
        "SELECT id, si, token, tf, df, round(weight, 6) AS weight FROM w"
    )
    sql["sentence_strength"] = with_(SENTS, weights("sents")) + """
      SELECT a.id, a.si, round(sum(a.weight * b.weight), 6) AS strength
      FROM w a JOIN w b ON a.id = b.id AND a.token = b.token AND a.si <> b.si GROUP BY ALL"""
    sql["lead_similarity"] = with_(SENTS, weights("sents")) + """
      SELECT b.id, b.si, round(sum(a.weight * b.weight), 6) AS similarity
      FROM w a JOIN w b ON a.id = b.id AND a.token = b.token WHERE a.si = 0 AND b.si <> 0 GROUP BY ALL"""
    sql["pagerank_scores"] = with_(SENTS, ranks("sents")) + (
        "SELECT id, si, round(score, 6) AS score FROM final"
    )
    sql["textrank_summary"] = with_(SENTS, textrank("sents")) + """
      SELECT id, 'textrank' AS method, coalesce(summary, '') AS summary FROM sents LEFT JOIN picked USING (id)"""
    sql["all_methods"] = with_(SENTS, textrank("sents")) + f"""
      SELECT id, {lead('s')} AS summary_lead_3, coalesce(summary, '') AS summary_textrank
      FROM sents LEFT JOIN picked USING (id)"""

    # scores
    three = "round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall"
    sql["rouge1"] = with_(SUMMARIES, R1) + f"SELECT id, method, {three} FROM r1"
    sql["rouge2"] = with_(SUMMARIES, R2) + f"SELECT id, method, {three} FROM r2"
    sql["rouge_l"] = with_(SUMMARIES, LCS) + f"SELECT id, method, {three} FROM rl"
    sql["rouge_lsum"] = sql["rouge_l"]  # cleaned text holds no line breaks
    sql["rouge1_stemmed"] = with_(STEMMED, R1) + f"SELECT id, method, {three} FROM r1"
    sql["rouge2_stemmed"] = with_(STEMMED, R2) + f"SELECT id, method, {three} FROM r2"
    sql["rouge_l_stemmed"] = with_(STEMMED, LCS) + f"SELECT id, method, {three} FROM rl"
    sql["qualitative_rows"] = with_(SUMMARIES, R1) + """
      SELECT id, source, method, reference_summary, generated_summary, summary_length,
             round(coalesce(ratio, 0), 6) AS compression, round(f1, 6) AS rouge1_f1
      FROM made JOIN r1 USING (id, method)"""
    means = """
      SELECT method, count(*) AS n_examples, round(avg(r1.f1), 6) AS rouge1, round(avg(r2.f1), 6) AS rouge2,
             round(avg(rl.f1), 6) AS "rougeL", round(avg(rl.f1), 6) AS "rougeLsum",
             round(avg(summary_length), 6) AS mean_summary_length,
             round(coalesce(avg(ratio), 0), 6) AS mean_compression_ratio
      FROM made JOIN r1 USING (id, method) JOIN r2 USING (id, method) JOIN rl USING (id, method) GROUP BY method"""
    sql["method_summary"] = with_(SUMMARIES, R1, R2, LCS) + means
    sql["method_summary_stemmed"] = with_(STEMMED, R1, R2, LCS) + means
    sql["blank_rows_summary"] = with_(SUMMARIES.replace("FROM checked WHERE reject_reason IS NULL", "FROM checked"), R1) + """
      SELECT method, count(*) AS n_examples, round(avg(f1), 6) AS rouge1,
             round(avg(summary_length), 6) AS mean_summary_length,
             round(coalesce(avg(ratio), 0), 6) AS mean_compression_ratio
      FROM made JOIN r1 USING (id, method) GROUP BY method"""
    sql["model_hook_stub"] = with_(DOCS) + """
      SELECT id, 'longest' AS method, list_reduce(string_split(article, '. '),
             lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) AS summary FROM docs"""
    sql["model_token_budget"] = with_(DOCS) + """
      SELECT id, 'stub' AS method, CASE WHEN article = '' THEN ''
             ELSE least(40, len(string_split(article, ' '))) || ' ' || array_to_string(string_split(article, ' ')[1:11], ' ') END AS summary FROM docs"""
    sql["rounded_report"] = with_(SUMMARIES, R1, R2, SUMMARY) + """
      SELECT method, n_examples, round(rouge1, 4) AS rouge1, round(mean_summary_length, 2) AS mean_summary_length,
             round(mean_compression_ratio, 4) AS mean_compression_ratio FROM summary"""
    sql["precision_recall"] = with_(SUMMARIES, R1, R2) + """
      SELECT r1.method, round(avg(r1.precision), 6) AS rouge1_precision, round(avg(r1.recall), 6) AS rouge1_recall,
             round(avg(r2.precision), 6) AS rouge2_precision, round(avg(r2.recall), 6) AS rouge2_recall
      FROM r1 JOIN r2 USING (id, method) GROUP BY r1.method"""

    # reports
    sql["length_describe"] = with_(PAIRS, f"""
      measures AS (
        SELECT unnest(['article_words', 'summary_words', 'sentence_count', 'reference_compression']) AS statistic,
               unnest([article_words, summary_words, len({sentence_list('article')}),
                       round(summary_words / greatest(1, article_words), 6)]::DOUBLE[]) AS value FROM pairs)"""
    ) + f"SELECT statistic, {dist('value')} FROM measures GROUP BY statistic"
    long = """scored AS (
      SELECT method, 'rouge1' AS variant, round(f1, 6) AS value FROM r1
      UNION ALL SELECT method, 'rouge2', round(f1, 6) FROM r2)"""
    sql["score_distribution"] = with_(SUMMARIES, R1, R2, long) + f"""
      SELECT method, variant, {dist('value')},
             round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr
      FROM scored GROUP BY method, variant"""
    sql["method_paired"] = with_(SUMMARIES, R1) + """
      SELECT 'textrank' AS left_method, 'lead_3' AS right_method,
             count(*) FILTER (round(a.f1, 6) > round(b.f1, 6)) AS left_wins,
             count(*) FILTER (round(a.f1, 6) < round(b.f1, 6)) AS right_wins,
             count(*) FILTER (round(a.f1, 6) = round(b.f1, 6)) AS ties
      FROM r1 a JOIN r1 b USING (id) WHERE a.method = 'textrank' AND b.method = 'lead_3'"""
    sql["best_worst"] = with_(SUMMARIES, R1) + """
      SELECT method, first(id ORDER BY s DESC, id) AS best_id, max(s) AS best_score,
             first(id ORDER BY s, id) AS worst_id, min(s) AS worst_score
      FROM (SELECT method, id, round(f1, 6) AS s FROM r1) GROUP BY method"""
    sql["length_histogram"] = with_(PAIRS, """
      lim AS (SELECT min(article_words)::DOUBLE AS lo, (max(article_words) - min(article_words)) / 20.0::DOUBLE AS w FROM pairs),
      filled AS (SELECT least(20, floor((article_words - lo) / w) + 1) AS bin, count(*) AS rows FROM pairs, lim GROUP BY ALL)"""
    ) + """
      SELECT b.bin::INT AS bin, round(lo + (b.bin - 1) * w, 6) AS from_words, round(lo + b.bin * w, 6) AS to_words,
             coalesce(rows, 0) AS rows
      FROM range(1, 21) b(bin) CROSS JOIN lim LEFT JOIN filled f ON f.bin = b.bin"""
    sql["rouge_pivot"] = with_(SUMMARIES, R1, R2) + """
      SELECT r1.method, round(avg(r1.f1), 6) AS rouge1, round(avg(r2.f1), 6) AS rouge2
      FROM r1 JOIN r2 USING (id, method) GROUP BY r1.method"""
    sql["rouge_matrix"] = with_(SUMMARIES, R1, R2) + """
      SELECT method, 'rouge1' AS variant, round(avg(f1), 6) AS f1 FROM r1 GROUP BY method
      UNION ALL SELECT method, 'rouge2', round(avg(f1), 6) FROM r2 GROUP BY method"""
    sql["score_curve"] = with_(SUMMARIES, R1) + """
      SELECT method, s AS score, min(p) AS from_position, max(p) AS to_position
      FROM (SELECT method, round(f1, 6) AS s,
                   row_number() OVER (PARTITION BY method ORDER BY round(f1, 6) DESC) AS p FROM r1) GROUP BY ALL"""
    quality = f"""
      {BAND} AS length_band, count(*) AS rows, round(avg(f1), 6) AS mean_rouge1_f1,
      round(avg(ratio), 6) AS mean_compression_ratio FROM made JOIN r1 USING (id, method)"""
    sql["quality_by_source"] = with_(SUMMARIES, R1) + f"SELECT method, source, {quality} GROUP BY ALL"
    sql["quality_by_label"] = with_(SUMMARIES, R1) + (
        f"SELECT method, quality, toxic, {quality} LEFT JOIN labels ON doc_id = id GROUP BY ALL"
    )
    sql["compression_by_method"] = with_(SUMMARIES) + """
      SELECT method, round(coalesce(avg(ratio), 0), 6) AS mean_compression_ratio,
             round(avg(summary_length), 6) AS mean_summary_length FROM made GROUP BY method"""

    # sources, sinks and checks
    missing = ", ".join(f"'{m}'" for m in P.MISSING)
    cell = lambda c: f"CASE WHEN {c} NOT IN ({missing}) THEN {c} END"
    sql["csv_records"] = f"""
      SELECT CAST(doc_id AS VARCHAR) AS id, {cell('source')} AS source, md5({cell('"text"')}) AS article, {cell('lang')} AS highlights FROM documents"""
    sql["tsv_records"] = """
      SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, "role", md5("text" || chr(9) || '"' || chr(10) || "role") AS text
      FROM conversations"""
    sql["jsonl_records"] = """
      SELECT CAST(page_id AS VARCHAR) AS page_id, CASE WHEN page_id % 2 = 0 THEN url END AS even_url, md5(html) AS html FROM pages"""
    sql["limited_rows"] = """
      SELECT '77' AS "limit", least(77, count(*)) AS rows, least(77, count(*)) AS ids FROM documents
      UNION ALL SELECT 'all', count(*), count(*) FROM documents"""
    sql["row_keys"] = """
      SELECT string_split(coalesce("text", ''), ' ')[1] AS article, coalesce(lang, '') AS highlights, count(*) AS rows, count(*) AS ids
      FROM documents GROUP BY ALL"""
    sql["written_scores"] = with_(SUMMARIES, R1) + """
      SELECT id, method, generated_summary, summary_length, round(f1, 6) AS rouge1_f1 FROM made JOIN r1 USING (id, method)"""
    sql["written_metrics"] = with_(SUMMARIES, R1) + """
      SELECT method, count(*) AS n_examples, round(avg(r1.f1), 6) AS rouge1, round(avg(summary_length), 6) AS mean_summary_length,
             round(coalesce(avg(ratio), 0), 6) AS mean_compression_ratio
      FROM made JOIN r1 USING (id, method) GROUP BY method"""
    sql["timed_scores"] = with_(SUMMARIES) + """
      SELECT method, count(*) AS rows, count(*) AS timed, CAST(0 AS BIGINT) AS too_long FROM made GROUP BY method"""
    sql["failed_checks"] = """
      SELECT * FROM (VALUES ('fine', 'passed'), ('no column', 'columns'), ('no rows', 'rows'), ('no articles', 'articles'),
        ('no summaries', 'summaries'), ('both', 'articles'), ('swapped', 'order'), ('swapped and blank', 'summaries')) v("table", stopped_by)"""

    sql["run_all_tables"] = with_(PAIRS, random_split("pairs")) + """
      SELECT 'prepared test' AS result, count(*) AS rows FROM parted WHERE part = 'test'
      UNION ALL SELECT 'prepared train', count(*) FROM parted WHERE part = 'train'
      UNION ALL SELECT 'rejected', (SELECT count(*) FROM documents) - count(*) FROM parted
      UNION ALL SELECT 'scores', 2 * count(*) FROM parted WHERE part = 'test'
      UNION ALL SELECT 'metrics', 2 UNION ALL SELECT 'summary', 2
      UNION ALL SELECT 'sources', count(DISTINCT source) FROM parted"""

    # corpora and pages
    sql["harmonised_union"] = """
      SELECT CAST(doc_id AS VARCHAR) AS id, 'documents' AS source, md5(text) AS article, lang AS highlights, 'test' AS split
      FROM documents
      UNION ALL SELECT md5('benchmark' || chr(1) || text || chr(1)), 'benchmark', md5(text), '', 'train' FROM benchmark
      UNION ALL SELECT md5('conversations' || chr(1) || text || chr(1) || role), 'conversations', md5(text), role, 'test'
      FROM conversations"""
    sql["page_articles"] = with_(PAGES) + "SELECT page_id, url, title, article, domain, status FROM parsed"
    remark = "'<article><p>A nested remark of more than eight words in all, on page ' || page_id || '</p>'"
    plain = f"flat AS MATERIALIZED (SELECT page_id, url, replace(html, '<article>', {remark}) AS html FROM pages)"
    sql["nested_articles"] = with_(plain, PAGES.replace("FROM pages", "FROM flat")) + (
        "SELECT page_id, url, title, article, domain, status FROM parsed")
    sql["old_entities"] = f"""
      SELECT page_id, concat('café © 2030 AT&T &uml é &x ¬it; ', {visible("regexp_extract(html, '<title>([^<]*)</title>', 1)")},
        ' R&D½Ü') AS text FROM pages"""
    sql["page_domain"] = with_(PAGES) + "SELECT domain, count(*) AS pages FROM parsed GROUP BY domain"
    sql["page_digest"] = with_(PAGES) + f"""
      SELECT page_id, url, title, article, domain, status, 'lead_3' AS method, {lead('s')} AS summary,
             len(s) <= 2 AS short_input FROM ok_pages"""
    sql["stream_digest"] = sql["page_digest"]
    sql["page_pairs_scored"] = with_(PAGES, f"""
      page_rows AS MATERIALIZED (
        SELECT page_id AS id, {words(lead('s'))} AS summary_length,
               regexp_extract_all(lower(title), '[a-z0-9]+') AS rt,
               regexp_extract_all(lower({lead('s')}), '[a-z0-9]+') AS ct FROM ok_pages WHERE status = 'ok')""",
        rouge_n("pr", 1, "page_rows", "id"),
    ) + "SELECT id, summary_length, round(f1, 6) AS rouge1_f1 FROM page_rows JOIN pr USING (id)"
    return sql
