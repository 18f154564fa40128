"""DuckDB twins of the queries in ``signalyard.plans.jobs``, beside those of
``tools.oracle_sql``."""

from __future__ import annotations

from tools.oracle_sql import ENTITIES, FEATURES, FIXTURE_CTES, NEGATIVE_WORDS, NO_CONTENT, ORACLE, POSITIVE_WORDS, _ctes, _inner_frame_ctes, q, r4

__all__ = ["ORACLE"]

# --- continued training ----------------------------------------------------------------
_TRAINING = _inner_frame_ctes() + ["""
lead AS (SELECT ctm - INTERVAL 1 HOUR AS ctm, open AS target FROM stock_lake)""", """
tf AS (SELECT CAST(date_start AS DATE) AS ds, CAST(date_end AS DATE) AS de, f.*, target
       FROM inner_frame f LEFT JOIN lead USING (ctm))""", """
tb AS (SELECT min(ds) AS o, max(de) AS m FROM tf)""", """
ti AS (SELECT tf.*, o, m, CAST(floor(datediff('day', o, ds) / 5) AS BIGINT) AS interval FROM tf, tb)""", """
tr AS (SELECT *, o + CAST(interval * 5 + 5 AS INTEGER) AS interval_end FROM ti
       WHERE interval >= 0 AND de < o + CAST(interval * 5 + 5 AS INTEGER) AND o + CAST(interval * 5 AS INTEGER) < m)"""]

ORACLE["walk_forward_resume"] = _ctes(_TRAINING + ["""
xy AS (SELECT interval, interval_end, coalesce(close, 0.0) AS x, target AS y FROM tr WHERE target IS NOT NULL)""", """
ends AS (SELECT DISTINCT interval, interval_end FROM xy)""", """
model AS (SELECT e.interval, e.interval_end, count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
          FROM ends e JOIN xy ON xy.interval <= e.interval GROUP BY 1, 2)""", """
early AS (SELECT max(de) AS m FROM tf WHERE ds < DATE '2024-01-15')""", """
last_saved AS (SELECT max(interval) AS k FROM tr, early WHERE ds < DATE '2024-01-15' AND tr.o + CAST(interval * 5 AS INTEGER) < early.m
               AND target IS NOT NULL)""", """
reads AS (SELECT count(*) FILTER (WHERE ds < DATE '2024-01-15') AS first_rows_read,
                 count(*) FILTER (WHERE ds >= o + CAST(k * 5 AS INTEGER)) AS second_rows_read
          FROM tf, tb, last_saved)"""]) + f"""
SELECT strftime(model.interval_end, '%Y-%m-%d') AS the_date, n AS n_rows, {r4('intercept')} AS intercept, {r4('slope')} AS w_close,
       {r4('avg(power(intercept + slope * x - y, 2))')} AS loss, first_rows_read, second_rows_read
FROM model JOIN xy USING (interval), reads GROUP BY 1, n, intercept, slope, first_rows_read, second_rows_read"""

_FEATURE_LIST = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in FEATURES)
_COLUMNS = [*FEATURES, "target"]
_PAIRS = ", ".join(f"struct_pack(a := '{a}', b := '{b}', c := covar_pop({x}, {y}), m := avg({y}))"
                   for i, a in enumerate(_COLUMNS) for b in _COLUMNS[i:]
                   for x, y in [[f"coalesce(CAST({v} AS DOUBLE), 0.0)" if v != "target" else "target" for v in (a, b)]])
ORACLE["walk_forward_statistics"] = _ctes(_TRAINING + [f"""
st AS (SELECT interval, count(*) AS n, unnest([{_PAIRS}]) AS p FROM tr WHERE target IS NOT NULL GROUP BY interval)"""]) + \
    f"SELECT interval, n, p.a AS a, p.b AS b, {r4('p.c')} AS covariance, {r4('p.m')} AS mean_b FROM st"

# The normal equations of each interval and those before it, centred, solved by
# Gauss-Jordan steps: row j of ``m`` holds the covariances with feature j, the
# last column those with the target.
_K = len(FEATURES)
_CELL = "covar_pop(x[{i}], x[{j}])"
_MATRIX = "[" + ", ".join("[" + ", ".join(
    (_CELL.format(i=i, j=j) if j <= _K else f"covar_pop(x[{i}], y)") for j in range(1, _K + 2)) + "]" for i in range(1, _K + 1)) + "]"
_STEPS = [f"""
g0 AS (SELECT interval, list_transform({_MATRIX}, lambda r, i: list_transform(r, lambda v, j:
              CASE WHEN i <> j THEN v WHEN v <= 0 THEN 1.0 ELSE v * (1 + 1e-6) END)) AS m,
              list_transform([{', '.join(f'avg(x[{i}])' for i in range(1, _K + 1))}], lambda v: v) AS mx, avg(y) AS my
       FROM upto GROUP BY interval)"""]
for _s in range(1, _K + 1):
    _STEPS.append(f"""
g{_s} AS (SELECT interval, mx, my, list_transform(m, lambda r, i: CASE WHEN i = {_s} THEN list_transform(r, lambda v: v / m[{_s}][{_s}])
                 ELSE list_transform(r, lambda v, j: v - r[{_s}] * m[{_s}][j] / m[{_s}][{_s}]) END) AS m FROM g{_s - 1})""")
ORACLE["walk_forward_features"] = _ctes(_TRAINING + [f"""
fx AS MATERIALIZED (SELECT interval, interval_end, ds, [{_FEATURE_LIST}] AS x, target AS y FROM tr)""", """
ends AS (SELECT DISTINCT interval FROM fx WHERE y IS NOT NULL)""", """
upto AS (SELECT e.interval, fx.x, fx.y FROM ends e JOIN fx ON fx.interval <= e.interval WHERE fx.y IS NOT NULL)""",
    *_STEPS, f"""
w AS (SELECT interval, list_transform(m, lambda r: r[{_K + 1}]) AS w, mx, my FROM g{_K})""", """
wm AS (SELECT interval, w, my - list_dot_product(w, mx) AS w0 FROM w)"""]) + f"""
SELECT strftime(ds, '%Y-%m-%d') AS record_date, fx.interval, strftime(interval_end, '%Y-%m-%d') AS the_date,
       {r4('greatest(w0 + list_dot_product(w, x), 0.0)')} AS predicted_open
FROM fx JOIN wm USING (interval)"""


# --- maintained daily aggregates -------------------------------------------------------
ORACLE["refresh_replace"] = _ctes([FIXTURE_CTES["news_items"]]) + f"""
SELECT substr(date, 1, 10) AS record_date, feed AS source, count(*) AS count, count(data) AS n_text,
       {r4('avg(length(data))')} AS mean_chars FROM news_items GROUP BY 1, 2"""
ORACLE["refresh_replace_weather"] = ORACLE["weather_daily"]


# --- windows in parts, late rows -------------------------------------------------------
_SLIDE_S, _WINDOW_S = 3 * 3600, 10 * 3600


def _pairs(events: str) -> str:
    """Each event of ``events`` (tm, event_type, value, ...) in each window it lies in."""
    return f"""
pairs AS (
  SELECT e.*, make_timestamp(CAST((floor(epoch(tm) / {_SLIDE_S}) - k) * {_SLIDE_S} * 1000000 AS BIGINT)) AS window_start,
         CASE WHEN event_type = 'purchase' THEN 'stock_list' ELSE 'news_list' END AS side
  FROM {events} e, range(0, 4) t(k)
  WHERE epoch(tm) < (floor(epoch(tm) / {_SLIDE_S}) - k) * {_SLIDE_S} + {_WINDOW_S})"""


ORACLE["window_join_parts"] = _ctes(["""
moved AS (SELECT CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-10 05:00:00' + to_seconds(minute(ts) * 60 + second(ts)) ELSE ts END AS tm,
                 event_type, value FROM events)""", _pairs("moved"), """
mark AS (SELECT least(max(tm) FILTER (WHERE event_type <> 'purchase'), max(tm) FILTER (WHERE event_type = 'purchase')) - INTERVAL 2 SECOND AS mark
         FROM moved)"""]) + f"""
SELECT window_start, window_start + INTERVAL 10 HOUR AS window_end, count(*) FILTER (WHERE side = 'news_list') AS n_news,
       count(*) FILTER (WHERE side = 'stock_list') AS n_stock, {r4("sum(value) FILTER (WHERE side = 'stock_list')")} AS stock_open_sum,
       true AS within_bound, true AS as_told
FROM pairs, mark GROUP BY window_start, mark
HAVING n_news > 0 AND n_stock > 0 AND window_end <= mark"""

ORACLE["late_rows"] = _ctes(["""
lots AS (SELECT ts AS tm, event_type, value,
                CAST(least(floor(greatest(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)), 0) / 8) + CASE event_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END, 3)
                     AS INTEGER) AS lot FROM events)""", """
tops AS (SELECT lot, max(tm) FILTER (WHERE event_type <> 'purchase') AS n, max(tm) FILTER (WHERE event_type = 'purchase') AS s FROM lots GROUP BY lot)""", """
marks AS (SELECT lot + 1 AS lot, least(max(n) OVER w, max(s) OVER w) - INTERVAL 2 SECOND AS mark, max(n) OVER w AS n, max(s) OVER w AS s
          FROM tops WINDOW w AS (ORDER BY lot))""", _pairs("lots"), """
told AS (SELECT pairs.*, n IS NOT NULL AND s IS NOT NULL AND window_start + INTERVAL 10 HOUR <= mark AS late
         FROM pairs LEFT JOIN marks USING (lot))""", """
counted AS (SELECT window_start, side, count(*) FILTER (WHERE NOT late) AS n_in_time, count(*) FILTER (WHERE late) AS n_late FROM told GROUP BY 1, 2)""", """
whole AS (SELECT window_start FROM counted GROUP BY 1 HAVING count(*) = 2 AND sum(n_late) > 0)"""]) + """
SELECT window_start, side, n_in_time, n_late, CASE WHEN window_start IN (SELECT window_start FROM whole) THEN n_in_time + n_late END AS n_corrected
FROM counted"""


# --- gaps of a log -----------------------------------------------------------------------
ORACLE["load_gaps"] = _ctes(["""
at5 AS (SELECT event_id, user_id, time_bucket(INTERVAL 5 MINUTE, ts) AS tm FROM events)""", """
rng AS (SELECT 'feed-' || CAST(user_id % 200 AS VARCHAR) AS feed,
               CASE WHEN event_id % 1009 = 0 THEN date_trunc('day', tm) WHEN event_id % 13 = 0 THEN date_trunc('hour', tm) ELSE tm END AS s,
               CASE WHEN event_id % 1009 = 0 THEN date_trunc('day', tm) + INTERVAL 3 DAY
                    WHEN event_id % 13 = 0 THEN date_trunc('hour', tm) + INTERVAL 1 HOUR ELSE tm + INTERVAL 5 MINUTE END AS e FROM at5)""", """
walked AS (SELECT feed, s, e, max(e) OVER (PARTITION BY feed ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM rng)""", """
gaps AS (SELECT feed, reach AS s, s AS e FROM walked WHERE reach < s
         UNION ALL SELECT feed, max(e) AS s, TIMESTAMP '2024-02-02' AS e FROM rng GROUP BY feed)""", """
clipped AS (SELECT feed, s, least(e, TIMESTAMP '2024-02-02') AS e FROM gaps WHERE s < least(e, TIMESTAMP '2024-02-02'))""", """
steps AS (SELECT feed, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS s, e FROM clipped)"""]) + """
SELECT feed, strftime(s, '%Y-%m-%dT%H:%M:%S') AS start_date, strftime(least(s + INTERVAL 1 DAY, e), '%Y-%m-%dT%H:%M:%S') AS end_date
FROM steps WHERE s < e"""


# --- text with depth -----------------------------------------------------------------------
# A stack of open elements, token by token; the given pages have no quoted '>' and
# these references only.
_VOID = ['area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr', 'script', 'style']
_REFERENCES = [*ENTITIES[:-1], ('&copy;', '\u00a9'), ('&middot;', '\u00b7'), ('&amp;', '&')]
_TEXT = "t"
for _ref, _char in _REFERENCES:
    _TEXT = f"replace({_TEXT}, {q(_ref)}, {q(_char)})"
_OPEN = "STRUCT(k INTEGER, depth INTEGER, txt VARCHAR)[]"
ORACLE["page_paragraphs_tree"] = f"""
WITH RECURSIVE toks AS MATERIALIZED (
  SELECT page_id, i, t, {_TEXT} AS txt, lower(regexp_extract(t, '^</?([A-Za-z][^ />\\s]*)', 1)) AS name,
         CASE WHEN t[1] <> '<' OR t = '<' THEN 'text' WHEN regexp_matches(t, '^<[!?]') THEN 'none' WHEN t[1:2] = '</' THEN 'end' ELSE 'start' END AS kind
  FROM (SELECT page_id, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i
        FROM (SELECT page_id, regexp_extract_all(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]+>|[^<]+|<') AS ts FROM pages))),
step AS (
  SELECT page_id, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS stack, CAST([] AS {_OPEN}) AS opened, 0 AS n, CAST([] AS {_OPEN}) AS done FROM pages
  UNION ALL
  SELECT page_id, i,
    CASE WHEN starts THEN list_append(stack, name) WHEN ends THEN stack[1:kept] ELSE stack END,
    CASE WHEN starts AND name = 'p' THEN list_append(opened, struct_pack(k := n, depth := CAST(len(stack) + 1 AS INTEGER), txt := ''))
         WHEN ends THEN list_filter(opened, lambda o: o.depth <= kept)
         WHEN kind = 'text' THEN list_transform(opened, lambda o: struct_pack(k := o.k, depth := o.depth, txt := o.txt || x.txt)) ELSE opened END,
    CASE WHEN starts AND name = 'p' THEN n + 1 ELSE n END,
    CASE WHEN ends THEN list_concat(done, list_filter(opened, lambda o: o.depth > kept)) ELSE done END
  FROM (SELECT s.page_id, t.i, stack, opened, n, done, name, kind, t.txt,
               kind = 'start' AND NOT ends_with(t.t, '/>') AND name NOT IN ({', '.join(q(v) for v in _VOID)}) AS starts,
               kind = 'end' AND list_contains(stack, name) AS ends,
               CAST(len(stack) - coalesce(list_position(list_reverse(stack), name), 0) AS INTEGER) AS kept
        FROM step s JOIN toks t ON t.page_id = s.page_id AND t.i = s.i + 1) x),
last_ AS (SELECT page_id, list_sort(list_concat(done, opened)) AS found FROM step QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i DESC) = 1),
texts AS (SELECT page_id, list_filter(list_transform(found, lambda o: o.txt), lambda v: regexp_matches(v, '[^\\s\\x{{a0}}]')) AS ts FROM last_),
joined AS (SELECT page_id, len(ts) AS n, CASE WHEN len(ts) > 0 THEN array_to_string(ts, chr(10)) ELSE {q(NO_CONTENT)} END AS j FROM texts)
SELECT page_id, n AS n_paragraphs, md5(j) AS text_md5, length(j) AS text_len FROM joined"""

_WORDS = "list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}]+', ' ', 'g')), ' '), lambda w: w <> '')"
ORACLE["language_trigrams"] = f"""
WITH d AS (SELECT doc_id, lang, text, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) AS INTEGER) % 4 = 2 AS held_out FROM documents),
w AS (SELECT doc_id, lang, held_out, unnest({_WORDS}) AS w FROM d),
g AS (SELECT doc_id, lang, held_out, substr(' ' || w || ' ', CAST(i AS INTEGER), 3) AS t FROM w, range(1, 100000) r(i) WHERE i <= length(w)),
counts AS (SELECT lang, t, count(*) AS n FROM g WHERE NOT held_out AND lang IS NOT NULL GROUP BY 1, 2),
totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY 1),
top AS (SELECT t FROM counts GROUP BY t ORDER BY sum(n) DESC, t LIMIT 5000),
profile AS (SELECT t, totals.lang AS code, ln((coalesce(n, 0) + 1) / (total + (SELECT count(*) FROM top))) AS p
            FROM top CROSS JOIN totals LEFT JOIN counts USING (lang, t)),
scored AS (SELECT doc_id, code, count(*) AS n_trigrams, sum(p) AS p FROM g JOIN profile USING (t) GROUP BY 1, 2),
best AS (SELECT doc_id, n_trigrams, code AS language FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, code) = 1)
SELECT doc_id, lang, held_out, coalesce(n_trigrams, 0) AS n_trigrams, language FROM d LEFT JOIN best USING (doc_id)"""


# --- fixed values: the words under which valences change, and their factors -------------------
STRONG_WORDS = ['great', 'excellent', 'best', 'wonderful', 'love', 'surge', 'rally', 'boost', 'crisis', 'worst', 'war', 'crash', 'collapse',
                'hate', 'disease', 'threat']
MILD_WORDS = ['up', 'record', 'stable', 'safe', 'support', 'agree', 'thanks', 'nice', 'down', 'drop', 'error', 'concern', 'risk', 'risks']
NEGATIONS = ['not', 'no', 'never', 'none', 'nobody', 'nothing', 'neither', 'nor', 'nowhere', 'without', 'cannot', 'hardly', 'barely', 'scarcely']
INTENSIFIERS = ['very', 'extremely', 'highly', 'really', 'so', 'most', 'absolutely', 'completely', 'deeply', 'greatly', 'incredibly',
                'particularly', 'remarkably', 'strongly', 'totally', 'truly']
DAMPENERS = ['slightly', 'somewhat', 'fairly', 'partly', 'little', 'marginally', 'mildly', 'almost', 'kind', 'sort', 'less']
CONTRASTS = ['but', 'however', 'yet']


def _in(words: list[str]) -> str:
    return "x.t IN (" + ", ".join(q(w) for w in words) + ")"


def _lists(words: list[str]) -> list[list[str]]:
    strong = [w for w in words if w in STRONG_WORDS]
    mild = [w for w in words if w in MILD_WORDS]
    return [strong, mild, [w for w in words if w not in strong + mild]]


# What a token is: sentence end, clause end, negation, intensifier, dampener, contrast, valued word, other word.
_KIND = f"""CASE WHEN {_in(['.', '!', '?'])} THEN 's' WHEN {_in([',', ';', ':', '(', ')'])} THEN 'c'
  WHEN {_in(NEGATIONS)} OR ends_with(x.t, {q("n't")}) THEN 'n' WHEN {_in(INTENSIFIERS)} THEN 'i' WHEN {_in(DAMPENERS)} THEN 'd'
  WHEN {_in(CONTRASTS)} THEN 'b' WHEN {_in(POSITIVE_WORDS + NEGATIVE_WORDS)} THEN 'v' ELSE 'w' END"""
_WEIGHT = "CASE " + " ".join(f"WHEN {_in(words)} THEN {sign * weight}.0" for sign, all_ in ((1, POSITIVE_WORDS), (-1, NEGATIVE_WORDS))
                             for weight, words in zip((3, 1, 2), _lists(all_))) + " ELSE 0.0 END"
# Token by token: windows in words, sums of the sentence (p, n) and of the text.
ORACLE["sentiment_scope"] = f"""
WITH RECURSIVE toks AS MATERIALIZED (
  SELECT doc_id, i, {_KIND} AS k, CAST({_WEIGHT} AS DOUBLE) AS wt
  FROM (SELECT doc_id, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(replace(lower(coalesce(text, '')), '’', {q("'")}), {q("[a-z]+(?:'[a-z]+)*|[.!?]|[,;:()]")}) AS ts FROM documents)) x),
step(doc_id, i, neg_left, boost_left, factor, after_, p, n, pos, neg, neu, words, hits) AS (
  SELECT doc_id, CAST(0 AS BIGINT), 0, 0, CAST(1 AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
         CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM documents
  UNION ALL
  SELECT doc_id, ti,
    CASE WHEN k IN ('s', 'c', 'b') THEN 0 WHEN k = 'n' THEN 3 ELSE greatest(neg_left - 1, 0) END,
    CASE WHEN k IN ('s', 'c', 'b') THEN 0 WHEN k IN ('i', 'd') THEN 2 ELSE greatest(boost_left - 1, 0) END,
    CASE WHEN k IN ('s', 'c', 'b') THEN 1.0 WHEN k = 'i' THEN f * 1.25 WHEN k = 'd' THEN f * 0.75 WHEN boost_left > 1 THEN factor ELSE 1.0 END,
    CASE k WHEN 's' THEN 1.0 WHEN 'b' THEN 1.5 ELSE after_ END,
    CASE k WHEN 's' THEN 0.0 WHEN 'b' THEN p * 0.5 WHEN 'v' THEN p + CASE WHEN v > 0 THEN v + 1 ELSE 0.0 END ELSE p END,
    CASE k WHEN 's' THEN 0.0 WHEN 'b' THEN n * 0.5 WHEN 'v' THEN n + CASE WHEN v < 0 THEN 1 - v ELSE 0.0 END ELSE n END,
    CASE k WHEN 's' THEN pos + p ELSE pos END, CASE k WHEN 's' THEN neg + n ELSE neg END,
    neu + CASE WHEN k IN ('s', 'c', 'v') THEN 0 ELSE 1 END, words + CASE WHEN k IN ('s', 'c') THEN 0 ELSE 1 END, hits + CASE k WHEN 'v' THEN 1 ELSE 0 END
  FROM (SELECT s1.*, t1.k, t1.i AS ti, t1.wt * f * after_ * CASE WHEN neg_left > 0 THEN -0.75 ELSE 1.0 END AS v
        FROM (SELECT *, CASE WHEN boost_left > 0 THEN factor ELSE 1.0 END AS f FROM step) s1
        JOIN toks t1 ON t1.doc_id = s1.doc_id AND t1.i = s1.i + 1)),
last_ AS (SELECT doc_id, words, hits, pos + p AS pos, neg + n AS neg, CAST(neu AS DOUBLE) AS neu FROM step
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1),
shares AS (SELECT doc_id, words, hits, CASE WHEN pos + neg + neu > 0 THEN neg / (pos + neg + neu) ELSE 0.0 END AS neg,
                  CASE WHEN pos + neg + neu > 0 THEN neu / (pos + neg + neu) ELSE 0.0 END AS neu,
                  CASE WHEN pos + neg + neu > 0 THEN pos / (pos + neg + neu) ELSE 0.0 END AS pos FROM last_)
SELECT doc_id, words AS n_words, hits AS n_valued, {r4('neg')} AS neg, {r4('neu')} AS neu, {r4('pos')} AS pos,
       CASE WHEN neg >= neu AND neg >= pos THEN 'neg' WHEN neu >= pos THEN 'neu' ELSE 'pos' END AS sentiment FROM shares"""


# --- tables ------------------------------------------------------------------------------------
ORACLE["envelope_hot_item"] = _ctes([FIXTURE_CTES["news_items"], """
rows_ AS (SELECT CASE WHEN (doc_id // 3) % 3 = 0 THEN 'All rights reserved.' ELSE data END AS data,
                 CASE WHEN (doc_id // 3) % 3 = 0 THEN '2024-01-09' ELSE substr(date, 1, 10) END AS date_start FROM news_items)"""]) + """
SELECT date_start, strftime(CAST(date_start AS DATE) + 1, '%Y-%m-%d') AS date_end, count(*) AS n_items,
       count(*) FILTER (WHERE data = 'All rights reserved.') AS n_hot, CAST(sum(length(data)) AS BIGINT) AS chars, true AS within_bound
FROM rows_ GROUP BY 1, 2"""

ORACLE["bucket_upsert"] = ORACLE["weather_daily"]

ORACLE["lake_triage"] = _ctes([FIXTURE_CTES["news_items"]]) + """
SELECT 'scraper_news_' || feed AS source, 'rows' AS what, count(*) AS n FROM news_items GROUP BY 1
UNION ALL
SELECT 'scraper_news_' || feed, what, CAST(1 AS BIGINT)
FROM (SELECT DISTINCT feed FROM news_items), (VALUES ('truncated'), ('empty'), ('not parquet'), ('another format'), ('other columns')) t(what)"""


# --- dates of a window's items -------------------------------------------------------------------
ORACLE["window_item_dates"] = _ctes(["""
ev AS (SELECT ts AS tm, event_type, value FROM events)""", _pairs("ev")]) + """
SELECT side, window_start, min(d) AS first_item, max(d) AS last_item, count(d) AS n_dated
FROM (SELECT side, window_start, CASE WHEN side = 'news_list' THEN CAST(date_trunc('day', tm) AS TIMESTAMP) ELSE date_trunc('second', tm) END AS d FROM pairs)
GROUP BY 1, 2"""
