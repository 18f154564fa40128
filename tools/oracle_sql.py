"""DuckDB twins of the registered queries.

The base tables are DuckDB views with the supplied names; each SQL text
re-derives the fixture feeds (``FIXTURE_CTES``) the same way
``sources.fixtures`` does, then states the operator as plain SQL."""

from __future__ import annotations

_DAY = "strftime({d}, '%Y-%m-%d')"

FIXTURE_CTES = {
    "news_items": """
news_items AS (
  SELECT doc_id,
         CASE doc_id % 3 WHEN 0 THEN 'newsapi' WHEN 1 THEN 'worldnewsapi' ELSE 'xtb' END AS feed,
         strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%dT10:00:00Z') AS date,
         text AS data,
         CASE doc_id % 3
           WHEN 0 THEN strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%d') || 'T10:00:00'
           WHEN 1 THEN strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%d') || ' 10:00:00'
           ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%d') END AS date_start,
         CASE doc_id % 3
           WHEN 0 THEN strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%d') || 'T10:05:00'
           WHEN 1 THEN strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER), '%Y-%m-%d') || ' 10:05:00'
           ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 29 AS INTEGER) + 1, '%Y-%m-%d') END AS date_end,
         lang
  FROM documents)""",
    "stock_lake": """
stock_lake AS (
  SELECT h AS ctm, strftime(h, '%b %-d, %Y, %-I:%M:%S %p') AS ctmString,
         o AS open, c - o AS close, hi - o AS high, lo - o AS low, CAST(n AS DOUBLE) AS vol,
         strftime(CAST(h AS DATE), '%Y-%m-%d') AS date_start,
         strftime(CAST(h AS DATE) + 1, '%Y-%m-%d') AS date_end
  FROM (SELECT date_trunc('hour', ts) AS h, arg_min(value, ts) AS o, arg_max(value, ts) AS c,
               max(value) AS hi, min(value) AS lo, count(*) AS n
        FROM events GROUP BY 1))""",
    "weather_raw": """
weather_raw AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN value END AS temperature,
         CASE WHEN event_type = 'error' THEN value END AS rain,
         CASE WHEN event_type = 'signup' THEN value * 60 END AS sun,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_start,
         strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS date_end
  FROM events)""",
    "scraper_logs": """
scraper_logs AS (
  SELECT CASE event_type WHEN 'view' THEN 'newsapi' WHEN 'click' THEN 'worldnewsapi' WHEN 'error' THEN 'xtb'
              WHEN 'signup' THEN 'openmeteo' ELSE 'stock' END AS feed,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS start_date,
         strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS end_date,
         count(*) AS record_count
  FROM events GROUP BY 1, 2, 3)""",
}


def with_ctes(*names: str, extra: list[str] | None = None) -> str:
    parts = [FIXTURE_CTES[n].strip() for n in names] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"


def r4(x: str) -> str:
    return f"round({x} + 1e-7, 4)"


ORACLE: dict[str, str] = {}

ORACLE["news_daily_counts"] = with_ctes("news_items") + """
SELECT strftime(CAST(substr(date, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
       feed AS source, count(*) AS count
FROM news_items GROUP BY 1, 2"""

ORACLE["news_new_rows"] = with_ctes("news_items", extra=["""
counts AS (
  SELECT strftime(CAST(substr(date, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
         feed AS source, count(*) AS count
  FROM news_items GROUP BY 1, 2)"""]) + """
SELECT * FROM counts c
WHERE NOT EXISTS (SELECT 1 FROM counts e
                  WHERE e.record_date < '2024-01-15'
                    AND e.record_date = c.record_date AND e.source = c.source)"""

ORACLE["weather_daily"] = with_ctes("weather_raw") + f"""
SELECT strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
       {r4('avg(temperature)')} AS temperature,
       {r4('coalesce(sum(rain), 0.0)')} AS rain,
       {r4('coalesce(sum(sun), 0.0)')} AS sun
FROM weather_raw GROUP BY 1"""

ORACLE["stock_new_rows"] = with_ctes("stock_lake") + """
SELECT strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
       CAST(open AS DOUBLE) AS open
FROM stock_lake
WHERE strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') >= '2024-01-15'"""


# --- SQL building blocks mirroring the library's column functions --------
# --- fixed values: what the library must use, stated here on its own ----------
SCRIPT_RE = '(?is)<script(?:\\s[^>]*)?>.*?</script\\s*>'
STYLE_RE = '(?is)<style(?:\\s[^>]*)?>.*?</style\\s*>'
PARAGRAPH_RE = '(?is)<p(?:\\s[^>]*)?>(.*?)</p>'
TAG_RE = '<[^>]+>'
NO_CONTENT = 'No content found'
ENTITIES = [('&lt;', '<'), ('&gt;', '>'), ('&quot;', '"'), ('&#39;', "'"), ('&nbsp;', '\xa0'), ('&amp;', '&')]
POSITIVE_WORDS = ['good', 'great', 'excellent', 'positive', 'gain', 'gains', 'growth', 'strong', 'rise', 'rising', 'rally',
 'profit', 'profits', 'success', 'successful', 'improve', 'improved', 'improvement', 'benefit', 'win',
 'best', 'better', 'happy', 'optimistic', 'boost', 'recovery', 'record', 'surge', 'favourable', 'favorable',
 'stable', 'safe', 'love', 'nice', 'wonderful', 'up', 'bullish', 'support', 'agree', 'thanks']
NEGATIVE_WORDS = ['bad', 'poor', 'negative', 'loss', 'losses', 'fall', 'falling', 'drop', 'decline', 'weak', 'crisis',
 'risk', 'risks', 'fear', 'fears', 'worse', 'worst', 'fail', 'failed', 'failure', 'shortage', 'drought',
 'disease', 'threat', 'war', 'conflict', 'down', 'bearish', 'crash', 'collapse', 'problem', 'problems',
 'hate', 'sad', 'angry', 'error', 'wrong', 'damage', 'concern', 'pessimistic']
LANGUAGE_PROFILES = {'de': ['der', 'die', 'und', 'den', 'von', 'zu', 'das', 'mit', 'sich', 'des', 'auf', 'ist', 'nicht', 'ein',
        'eine', 'dem', 'im', 'als', 'auch', 'werden'],
 'en': ['the', 'of', 'and', 'to', 'in', 'is', 'that', 'it', 'for', 'was', 'on', 'with', 'by', 'as', 'this',
        'are', 'at', 'from', 'be', 'have', 'not', 'but', 'which'],
 'es': ['el', 'los', 'las', 'del', 'que', 'y', 'por', 'con', 'para', 'una', 'se', 'al', 'lo', 'como', 'su',
        'pero', 'mas', 'esta', 'es'],
 'fr': ['le', 'les', 'des', 'du', 'et', 'qui', 'pour', 'par', 'au', 'aux', 'une', 'est', 'dans', 'sur',
        'pas', 'elle', 'avec', 'ce', 'il', 'plus']}
LANGUAGE_ORDER = ['de', 'en', 'es', 'fr']
CLEAN_PATTERNS_LITERAL = [('<[^>]+>', ''), ('\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\\\.[A-Za-z]{2,}\\b', ''),
 ('http[s]?://\\\\S+|www\\\\.\\\\S+', ''), ('\\\\b\\\\d{10,}\\\\b', ''), ('\\\\s+', ' '),
 ('[^a-zA-Z0-9\\\\s]', '')]
CLEAN_PATTERNS_INTENDED = [('<[^>]+>', ''), ('\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b', ''),
 ('http[s]?://\\S+|www\\.\\S+', ''), ('\\b\\d{10,}\\b', ''), (r'[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' '), ('[^a-zA-Z0-9\\s]', '')]
FEATURES = ['open', 'close', 'high', 'low', 'vol', 'temperature', 'rain', 'sun', 'sentiment', 'language']
FINAL_COLUMNS = ['ctm', 'ctmString', 'open', 'close', 'high', 'low', 'vol', 'date_start', 'date_end', 'temperature', 'rain',
 'sun', 'date', 'data', 'sentiment', 'language']


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_clean(x: str, mode: str = "literal") -> str:
    pats = CLEAN_PATTERNS_LITERAL if mode == "literal" else CLEAN_PATTERNS_INTENDED
    out = x
    for i, (p, r) in enumerate(pats):
        out = f"regexp_replace({out}, {q(p)}, {q(r)}, 'g')"
        if i == 4:
            out = f"trim({out})"
    return f"coalesce(lower({out}), '')"


def sql_tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def sql_hits(tok: str, words: list[str]) -> str:
    return f"len(list_filter({tok}, lambda t: t IN ({', '.join(q(w) for w in words)})))"


def sql_sentiment(n: str, p: str, q_: str) -> str:
    u = f"({n} - {p} - {q_})"
    return (f"CASE WHEN {q_} >= {u} AND {q_} >= {p} THEN 'neg' "
            f"WHEN {u} >= {p} THEN 'neu' ELSE 'pos' END")


def sql_language(cols: dict[str, str]) -> str:
    best = f"greatest({', '.join(cols[c] for c in LANGUAGE_ORDER)})"
    out = f"CASE WHEN {best} <= 0 THEN NULL "
    for c in LANGUAGE_ORDER:
        out += f"WHEN {cols[c]} = {best} THEN {q(c)} "
    return out + "END"


def scored_news_ctes(src: str = "news_items", name: str = "news_scored",
                     text_mode: str = "literal") -> list[str]:
    """CTEs adding data (cleaned), sentiment, language to a news CTE."""
    lang_hits = ", ".join(f"{sql_hits('tok', LANGUAGE_PROFILES[c])} AS l_{c}" for c in LANGUAGE_ORDER)
    return [f"""
{name}_tok AS (
  SELECT *, {sql_tokens(sql_clean('data', 'intended'))} AS tok FROM {src})""", f"""
{name}_hits AS (
  SELECT *, len(tok) AS n_tok, {sql_hits('tok', POSITIVE_WORDS)} AS p_hits,
         {sql_hits('tok', NEGATIVE_WORDS)} AS q_hits, {lang_hits}
  FROM {name}_tok)""", f"""
{name} AS (
  SELECT * EXCLUDE (data, tok, n_tok, p_hits, q_hits, {', '.join('l_' + c for c in LANGUAGE_ORDER)}),
         {sql_clean('data', text_mode)} AS data,
         {sql_sentiment('n_tok', 'p_hits', 'q_hits')} AS sentiment,
         {sql_language({c: 'l_' + c for c in LANGUAGE_ORDER})} AS language
  FROM {name}_hits)"""]


def sql_paragraph_text(html: str) -> str:
    body = f"regexp_replace(regexp_replace({html}, {q(SCRIPT_RE)}, '', 'g'), {q(STYLE_RE)}, '', 'g')"
    dec = f"regexp_replace(p, {q(TAG_RE)}, '', 'g')"
    for ent, ch in ENTITIES:
        dec = f"replace({dec}, {q(ent)}, {q(ch)})"
    paras = (f"list_filter(list_transform(regexp_extract_all({body}, {q(PARAGRAPH_RE)}, 1), "
             f"lambda p: {dec}), lambda t: regexp_matches(t, '\\S'))")
    return paras


# --- text queries ------------------------------------------------------------
_KEYWORDS = ["The", "License"]

ORACLE["clean_text_literal"] = f"""
SELECT doc_id, md5(c) AS clean_md5, CAST(length(c) AS BIGINT) AS clean_len
FROM (SELECT doc_id, {sql_clean('text', 'literal')} AS c FROM documents)"""

ORACLE["clean_text_intended"] = f"""
SELECT doc_id, md5(c) AS clean_md5, CAST(length(c) AS BIGINT) AS clean_len
FROM (SELECT doc_id, {sql_clean('text', 'intended')} AS c FROM documents)"""

ORACLE["keyword_all"] = "SELECT doc_id FROM documents WHERE " + " AND ".join(
    f"contains(lower(text), {q(k.lower())})" for k in _KEYWORDS)

ORACLE["keyword_all_literal"] = "\nUNION ALL\n".join(
    f"SELECT doc_id, {q(' '.join(ks))} AS keywords FROM documents WHERE " + " AND ".join(
        f"contains(lower(text), {q(k)})" for k in ks) for ks in (_KEYWORDS, [k.lower() for k in _KEYWORDS]))

ORACLE["page_paragraphs"] = f"""
SELECT page_id, CAST(len(ps) AS BIGINT) AS n_paragraphs, md5(t) AS text_md5,
       CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT page_id, ps,
             CASE WHEN len(ps) > 0 THEN array_to_string(ps, chr(10)) ELSE {q(NO_CONTENT)} END AS t
      FROM (SELECT page_id, {sql_paragraph_text('html')} AS ps FROM pages))"""

ORACLE["sentiment_label"] = f"""
SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, CAST(p AS BIGINT) AS pos_hits,
       CAST(g AS BIGINT) AS neg_hits, {sql_sentiment('n', 'p', 'g')} AS sentiment
FROM (SELECT doc_id, len(tok) AS n, {sql_hits('tok', POSITIVE_WORDS)} AS p,
             {sql_hits('tok', NEGATIVE_WORDS)} AS g
      FROM (SELECT doc_id, {sql_tokens(sql_clean('text', 'intended'))} AS tok FROM documents))"""

_LANG_FROM_DOCS = "WITH " + ",\n".join(c.strip() for c in scored_news_ctes(
    "(SELECT doc_id, lang, text AS data FROM documents)", "lg")) + "\n"
# the scored CTE builder expects a named source
_LANG_FROM_DOCS = _LANG_FROM_DOCS.replace(
    "FROM (SELECT doc_id, lang, text AS data FROM documents))",
    "FROM (SELECT doc_id, lang, text AS data FROM documents) AS src)")

ORACLE["language_guess"] = _LANG_FROM_DOCS + "SELECT doc_id, lang, language FROM lg"

ORACLE["label_encode"] = """
SELECT doc_id, lang,
       CAST(CASE WHEN lang IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY lang) - 1 END AS BIGINT)
         AS lang_code
FROM documents"""

ORACLE["label_encode_missing"] = _LANG_FROM_DOCS + """
SELECT doc_id, coalesce(language, 'nan') AS language,
       CAST(dense_rank() OVER (ORDER BY coalesce(language, 'nan')) - 1 AS BIGINT) AS language_code
FROM lg"""


# --- training frames ---------------------------------------------------------
_WEATHER_LAKE = """
weather_lake AS (
  SELECT date_start, date_end, avg(temperature) AS temperature,
         coalesce(sum(rain), 0.0) AS rain, coalesce(sum(sun), 0.0) AS sun
  FROM weather_raw GROUP BY 1, 2)"""
_DOUBLES = {"open", "close", "high", "low", "vol", "temperature", "rain", "sun"}
_SENT_CODE = "CASE sentiment WHEN 'pos' THEN 1 WHEN 'neu' THEN 0 WHEN 'neg' THEN -1 END"


def _report_cols(cols: list[str], doubles=_DOUBLES, ints=("sentiment", "language")) -> str:
    out = []
    for c in cols:
        if c == "data":
            out.append("md5(data) AS data_md5")
        elif c in doubles:
            out.append(f"{r4(c)} AS {c}")
        elif c in ints:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(f'"{c}"' if c == "date" else c)
    return ", ".join(out)


def _frame_base() -> list[str]:
    return [FIXTURE_CTES["news_items"], FIXTURE_CTES["stock_lake"], FIXTURE_CTES["weather_raw"],
            _WEATHER_LAKE, '\nnews AS (SELECT "date", data, date_start, date_end FROM news_items)',
            *scored_news_ctes("news", "ns")]


def _inner_frame_ctes() -> list[str]:
    return _frame_base() + ["""
fj AS (
  SELECT ctm, ctmString, open, close, high, low, vol,
         TRY_CAST(date_start AS TIMESTAMP) AS date_start, TRY_CAST(date_end AS TIMESTAMP) AS date_end,
         temperature, rain, sun, "date", data, """ + _SENT_CODE + """ AS sentiment, language
  FROM ns JOIN weather_lake USING (date_start, date_end) JOIN stock_lake USING (date_start, date_end))""",
                            """
fcodes AS (
  SELECT language AS lk, row_number() OVER (ORDER BY language) - 1 AS code
  FROM (SELECT DISTINCT language FROM fj WHERE language IS NOT NULL))""",
                            """
inner_frame AS (
  SELECT fj.* EXCLUDE (language), fcodes.code AS language
  FROM fj LEFT JOIN fcodes ON fj.language = fcodes.lk)"""]


def _day_key(c: str) -> str:
    return f"strptime(substr({c}, 1, 10), '%Y-%m-%d')"


def _outer_frame_ctes() -> list[str]:
    keyed = [f"""
{a} AS (SELECT * REPLACE ({_day_key('date_start')} AS date_start, {_day_key('date_end')} AS date_end)
        FROM {b})""" for a, b in (("nk", "ns"), ("wk", "weather_lake"), ("sk", "stock_lake"))]
    means = ", ".join(
        ["make_timestamp(CAST(floor(avg(epoch(ctm))) AS BIGINT) * 1000000) AS ctm"] +
        [f"avg({c}) AS {c}" for c in ["open", "close", "high", "low", "vol", "temperature", "rain", "sun"]])
    final = ", ".join(f"coalesce(o4.{c}, om.{c}) AS {c}"
                      if c in _DOUBLES or c == "ctm" else (f'o4."{c}"' if c == "date" else f"o4.{c}")
                      for c in FINAL_COLUMNS)
    return _frame_base() + keyed + ["""
o1 AS (
  SELECT coalesce(nk.date_start, wk.date_start) AS date_start,
         coalesce(nk.date_end, wk.date_end) AS date_end,
         nk."date", nk.data, nk.sentiment, nk.language, wk.temperature, wk.rain, wk.sun
  FROM nk FULL OUTER JOIN wk ON nk.date_start = wk.date_start AND nk.date_end = wk.date_end)""", """
o2 AS (
  SELECT coalesce(o1.date_start, sk.date_start) AS date_start,
         coalesce(o1.date_end, sk.date_end) AS date_end,
         o1."date", o1.data, o1.sentiment, o1.language, o1.temperature, o1.rain, o1.sun,
         sk.ctm, sk.ctmString, sk.open, sk.close, sk.high, sk.low, sk.vol
  FROM o1 FULL OUTER JOIN sk ON o1.date_start = sk.date_start AND o1.date_end = sk.date_end)""", """
o3 AS (SELECT * REPLACE (""" + _SENT_CODE + """ AS sentiment, coalesce(language, 'nan') AS language)
       FROM o2)""", """
ocodes AS (
  SELECT language AS lk, row_number() OVER (ORDER BY language) - 1 AS code
  FROM (SELECT DISTINCT language FROM o3 WHERE language IS NOT NULL))""", """
o4 AS (SELECT o3.* EXCLUDE (language), ocodes.code AS language
       FROM o3 LEFT JOIN ocodes ON o3.language = ocodes.lk)""", f"""
om AS (SELECT {means} FROM o4)""", f"""
outer_frame AS (SELECT {final} FROM o4, om)"""]


def _ranged_ctes() -> list[str]:
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in FEATURES)
    cols = ", ".join(f"coalesce(CAST(r1.{c} AS DOUBLE), rm.{c}) AS {c}" if c in FEATURES
                     else (f'r1."{c}"' if c == "date" else f"r1.{c}") for c in FINAL_COLUMNS)
    return _outer_frame_ctes() + ["""
r1 AS (SELECT * FROM outer_frame
       WHERE date_start >= TIMESTAMP '2024-01-05' AND date_end <= TIMESTAMP '2024-01-20')""", f"""
rm AS (SELECT {means} FROM r1)""", f"""
ranged AS (SELECT {cols} FROM r1, rm)"""]


def _ctes(parts: list[str]) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


ORACLE["frame_inner"] = _ctes(_inner_frame_ctes()) + \
    f"SELECT {_report_cols(FINAL_COLUMNS)} FROM inner_frame"

ORACLE["frame_outer_imputed"] = _ctes(_outer_frame_ctes()) + \
    f"SELECT {_report_cols(FINAL_COLUMNS)} FROM outer_frame"

ORACLE["frame_range"] = _ctes(_ranged_ctes()) + \
    f"SELECT {_report_cols(FINAL_COLUMNS, _DOUBLES | {'sentiment', 'language'}, ())} FROM ranged"

ORACLE["distinct_dates"] = _ctes(_ranged_ctes()) + \
    "SELECT DISTINCT strftime(date_start, '%Y-%m-%d') AS day FROM ranged"


def _tail_ctes() -> list[str]:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ['date_start', 'date_end', 'ctm', '"date"', 'data'])
    aggs = ", ".join([f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in FEATURES[:8]] +
                     [f"median(CAST({c} AS DOUBLE)) AS {c}" for c in ("sentiment", "language")])
    return _inner_frame_ctes() + [f"""
tail7 AS (SELECT * FROM inner_frame ORDER BY {order} LIMIT 7)""", f"""
means AS (SELECT 'means' AS _id, {aggs} FROM tail7)"""]


ORACLE["means_tail7"] = _ctes(_tail_ctes()) + \
    "SELECT _id, " + ", ".join(f"{r4(c)} AS {c}" for c in FEATURES) + " FROM means"

ORACLE["means_unpivot"] = _ctes(_tail_ctes()) + "\nUNION ALL\n".join(
    f"SELECT {q(c)} AS Parameter, {r4(c)} AS Value FROM means WHERE _id = 'means'" for c in FEATURES)

ORACLE["predict_defaults"] = _ctes(_tail_ctes()) + "SELECT ctm, " + ", ".join(
    r4(f"coalesce({src}, means.{c}, 0.0)") + f" AS {c}" for c, src in
    [("open", "CASE WHEN hour(ctm) % 12 = 0 THEN NULL ELSE stock_lake.open END"),
     ("close", "stock_lake.close"), ("high", "stock_lake.high"), ("low", "stock_lake.low"),
     ("vol", "stock_lake.vol")] +
    [(c, "CAST(NULL AS DOUBLE)") for c in FEATURES[5:]]) + \
    " FROM stock_lake LEFT JOIN means ON TRUE"


# --- envelopes ---------------------------------------------------------------
_MSGS = """
msgs AS (
  SELECT 'scraper_news_' || feed AS source, date_start, date_end, count(*) AS n
  FROM news_items GROUP BY 1, 2, 3
  UNION ALL SELECT 'scraper_stock_xtb', date_start, date_end, count(*) FROM stock_lake GROUP BY 1, 2, 3
  UNION ALL SELECT 'scraper_weather_openmeteo', date_start, date_end, count(*) FROM weather_lake GROUP BY 1, 2, 3)"""
_ENV_BASE = [FIXTURE_CTES["news_items"], FIXTURE_CTES["stock_lake"], FIXTURE_CTES["weather_raw"],
             _WEATHER_LAKE, _MSGS]

ORACLE["envelope_news"] = _ctes([FIXTURE_CTES["news_items"]]) + """
SELECT 'scraper_news_' || feed AS source, "date", md5(data) AS data_md5, date_start, date_end
FROM news_items"""

_STOCK_COLS = ["ctm", "ctmString", "open", "close", "high", "low", "vol", "date_start", "date_end"]
ORACLE["envelope_stock"] = _ctes([FIXTURE_CTES["stock_lake"]]) + \
    f"SELECT {_report_cols(_STOCK_COLS)} FROM stock_lake"

ORACLE["envelope_weather"] = _ctes([FIXTURE_CTES["weather_raw"], _WEATHER_LAKE]) + \
    f"SELECT {_report_cols(['temperature', 'rain', 'sun', 'date_start', 'date_end'])} FROM weather_lake"

ORACLE["envelope_kinds"] = _ctes(_ENV_BASE) + """
SELECT source,
       CASE split_part(source, '_', 2) WHEN 'news' THEN 'news' WHEN 'stock' THEN 'candlesticks'
            ELSE 'weather' END AS kind,
       date_start, date_end, CAST(n AS BIGINT) AS record_count
FROM msgs"""

ORACLE["count_batches"] = _ctes(_ENV_BASE + ["""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY date_start, date_end) AS rn,
         count(*) OVER (PARTITION BY source) AS total,
         CASE split_part(source, '_', 2) WHEN 'news' THEN 5 WHEN 'stock' THEN 10
              WHEN 'weather' THEN 1 ELSE 1 END AS lim
  FROM msgs)"""]) + """
SELECT source, CAST(floor((rn - 1) / lim) AS BIGINT) AS batch_id, count(*) AS n_messages,
       CAST(sum(n) AS BIGINT) AS n_records, min(date_start) AS first_start, max(date_start) AS last_start
FROM numbered WHERE floor((rn - 1) / lim) < floor(total / lim)
GROUP BY 1, 2"""


# --- logs, cursor, serving ---------------------------------------------------
ORACLE["logs_union"] = _ctes([FIXTURE_CTES["scraper_logs"]]) + \
    "SELECT start_date, record_count, feed AS source FROM scraper_logs"

ORACLE["last_cursor"] = _ctes([FIXTURE_CTES["scraper_logs"]]) + \
    "SELECT feed, max(end_date) AS end_date FROM scraper_logs GROUP BY feed"


def _windows_sql(first: str) -> str:
    return _ctes([FIXTURE_CTES["scraper_logs"], f"""
bounds AS (SELECT feed, {first} AS s0 FROM scraper_logs GROUP BY feed)""", """
win AS (
  SELECT feed, s0, CAST(unnest(generate_series(CAST(s0 AS TIMESTAMP),
                                                CAST(greatest(s0, DATE '2024-02-02' - 1) AS TIMESTAMP),
                                                INTERVAL 1 DAY)) AS DATE) AS s
  FROM bounds WHERE s0 <= DATE '2024-02-02')"""]) + """
SELECT feed, strftime(s, '%Y-%m-%d') AS start_date, strftime(s + 1, '%Y-%m-%d') AS end_date
FROM win
WHERE (s < DATE '2024-02-02' OR (s = s0 AND s0 = DATE '2024-02-02'))
  AND NOT EXISTS (SELECT 1 FROM scraper_logs l
                  WHERE l.feed = win.feed AND l.start_date = strftime(win.s, '%Y-%m-%d'))"""


ORACLE["load_windows"] = _windows_sql("min(CAST(start_date AS DATE))")
ORACLE["load_windows_tail"] = _windows_sql("max(CAST(end_date AS DATE))")

_REAL_PRED = [FIXTURE_CTES["stock_lake"], """
real AS (SELECT strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
                CAST(open AS DOUBLE) AS real_open FROM stock_lake)""", """
pred AS (SELECT strftime(CAST(record_date AS DATE) + 1, '%Y-%m-%d') AS record_date,
                avg(real_open) AS predicted_open FROM real GROUP BY record_date)"""]

ORACLE["pred_vs_real"] = _ctes(_REAL_PRED) + f"""
SELECT coalesce(r.record_date, p.record_date) AS record_date,
       {r4('p.predicted_open')} AS predicted_open, {r4('r.real_open')} AS real_open
FROM real r FULL OUTER JOIN pred p ON r.record_date = p.record_date"""

ORACLE["weather_series"] = with_ctes("weather_raw") + f"""
SELECT strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') AS record_date,
       {r4('avg(temperature)')} AS temperature,
       {r4('coalesce(sum(rain), 0.0)')} AS rain,
       {r4('coalesce(sum(sun), 0.0) / 60')} AS sun_minutes
FROM weather_raw GROUP BY 1"""

ORACLE["news_series"] = ORACLE["news_daily_counts"]


# --- weather by region, dates, intervals -------------------------------------
ORACLE["regional_weather"] = """
WITH rd AS (
  SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CAST(user_id % 5 AS VARCHAR) AS region,
         min(value) AS tmin, max(value) AS tmax, sum(value) AS rain, sum(value) * 60 AS sun
  FROM events GROUP BY 1, 2),
loc AS (SELECT * FROM (VALUES ('0', 'A', 0.4, 0.6), ('1', 'A', 0.6, 0.6), ('2', 'B', 0.3, 0.4),
                              ('3', 'B', 0.3, 0.4), ('4', 'B', 0.4, 0.4)) AS t(region, country, rw, cw)),
pc AS (
  SELECT day, country, avg((tmin + tmax) / 2 * rw) * max(cw) AS temperature,
         avg(rain * rw) * max(cw) AS rain, avg(sun * rw) * max(cw) AS sun
  FROM rd JOIN loc USING (region) GROUP BY day, country)
SELECT day, """ + ", ".join(f"{r4(f'avg({c})')} AS {c}" for c in ("temperature", "rain", "sun")) + \
    " FROM pc GROUP BY day"

ORACLE["date_pairs"] = """
WITH b AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events),
d AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d, e
      FROM b)
SELECT strftime(d, '%Y-%m-%d') AS start_date, strftime(d + 1, '%Y-%m-%d') AS end_date FROM d WHERE d < e"""

ORACLE["date_functions"] = _ctes([FIXTURE_CTES["stock_lake"]]) + """
SELECT ctm,
       strftime(strptime(ctmString, '%b %d, %Y, %I:%M:%S %p'), '%Y-%m-%dT%H:%M:%SZ') AS broker_time,
       strptime(ctmString, '%b %d, %Y, %I:%M:%S %p') AS candle_time,
       strftime(strptime(date_start, '%Y-%m-%d') + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
       strftime(strptime(date_start, '%Y-%m-%d') - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_day,
       strftime(ctm + INTERVAL 5 MINUTE, '%Y-%m-%dT%H:%M:%S') AS plus_5min,
       strptime(date_start, '%Y-%m-%d') < strptime(date_end, '%Y-%m-%d') AS starts_before_end,
       strptime(date_start, '%Y-%m-%d') = strptime(date_end, '%Y-%m-%d') AS same_day,
       strftime(ctm, '%Y_%m') AS month
FROM stock_lake"""

_IV = [FIXTURE_CTES["stock_lake"], """
b AS (SELECT min(CAST(date_start AS DATE)) AS o, max(CAST(date_end AS DATE)) AS m FROM stock_lake)""", """
iv0 AS (
  SELECT s.*, CAST(floor(datediff('day', b.o, CAST(s.date_start AS DATE)) / 5) AS BIGINT) AS interval,
         b.o, b.m
  FROM stock_lake s, b)""", """
iv AS (
  SELECT * EXCLUDE (o, m), o + CAST(interval * 5 AS INTEGER) AS interval_start,
         o + CAST(interval * 5 + 5 AS INTEGER) AS interval_end
  FROM iv0
  WHERE interval >= 0 AND CAST(date_end AS DATE) < o + CAST(interval * 5 + 5 AS INTEGER)
    AND o + CAST(interval * 5 AS INTEGER) < m)""", """
coef AS (SELECT interval, interval_start, interval_end, count(*) AS n_rows,
                regr_slope(close, open) AS slope, regr_intercept(close, open) AS intercept
         FROM iv GROUP BY 1, 2, 3)"""]

ORACLE["interval_rows"] = _ctes(_IV) + \
    "SELECT interval, interval_start, interval_end, count(*) AS n_rows FROM iv GROUP BY 1, 2, 3"

ORACLE["interval_regression"] = _ctes(_IV) + \
    f"SELECT interval, interval_start, interval_end, n_rows, {r4('slope')} AS slope, " \
    f"{r4('intercept')} AS intercept FROM coef"

ORACLE["interval_loss"] = _ctes(_IV) + f"""
SELECT iv.interval, iv.interval_start, iv.interval_end, count(*) AS n_rows,
       {r4('avg(power(coef.intercept + coef.slope * iv.open - iv.close, 2))')} AS loss
FROM iv JOIN coef USING (interval) GROUP BY 1, 2, 3"""


# --- speed layer ---------------------------------------------------------------
_SLIDE_S, _WIN_S = 3 * 3600, 10 * 3600
_WINDOWS = f"""
ev AS (SELECT ts, event_type, value FROM events),
w AS (
  SELECT make_timestamp(CAST((floor(epoch(ts) / {_SLIDE_S}) - k) * {_SLIDE_S} * 1000000 AS BIGINT)) AS ws,
         ts, event_type, value
  FROM ev, range(0, 4) t(k)
  WHERE epoch(ts) < (floor(epoch(ts) / {_SLIDE_S}) - k) * {_SLIDE_S} + {_WIN_S}),
agg AS (
  SELECT ws, count(*) FILTER (WHERE event_type <> 'purchase') AS n_news,
         count(*) FILTER (WHERE event_type = 'purchase') AS n_stock,
         sum(value) FILTER (WHERE event_type = 'purchase') AS stock_open_sum
  FROM w GROUP BY ws)"""
_WIN_SELECT = f"""
SELECT ws AS window_start, ws + INTERVAL 10 HOUR AS window_end, n_news, n_stock,
       {r4('stock_open_sum')} AS stock_open_sum
FROM agg WHERE n_news > 0 AND n_stock > 0"""

ORACLE["window_join_batch"] = "WITH " + _WINDOWS.strip() + _WIN_SELECT

# Stream: only windows the final watermark has closed are emitted; the
# watermark is the smaller of the two inputs' max event time, minus 2 s.
ORACLE["window_join_stream"] = "WITH " + _WINDOWS.strip() + """,
wm AS (SELECT least(max(ts) FILTER (WHERE event_type <> 'purchase'),
                    max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 2 SECOND AS wm FROM ev)""" + \
    _WIN_SELECT + " AND ws + INTERVAL 10 HOUR <= (SELECT wm FROM wm)"


# --- stateful batching, lake, refresh -----------------------------------------
ORACLE["stream_batches"] = ORACLE["count_batches"]

ORACLE["lake_roundtrip"] = _ctes([FIXTURE_CTES["news_items"]]) + """
SELECT feed AS source, "date", md5(data) AS data_md5, date_start, date_end,
       strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y_%m') AS month
FROM news_items"""

ORACLE["refresh_news_counts"] = ORACLE["news_daily_counts"]

ORACLE["envelope_to_lake"] = _ctes(_ENV_BASE + ["""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY date_start, date_end) AS rn,
         count(*) OVER (PARTITION BY source) AS total,
         CASE split_part(source, '_', 2) WHEN 'news' THEN 5 WHEN 'stock' THEN 10
              WHEN 'weather' THEN 1 ELSE 1 END AS lim
  FROM msgs)"""]) + """
SELECT source, date_start, date_end, CAST(n AS BIGINT) AS n_rows
FROM numbered WHERE floor((rn - 1) / lim) < floor(total / lim)"""


# --- walk-forward model with one predictor ----------------------------------------
_MODEL = ["""
lead AS (SELECT ctm - INTERVAL 1 HOUR AS ctm, open AS target FROM stock_lake)""", """
mf AS (SELECT CAST(date_start AS DATE) AS ds, CAST(date_end AS DATE) AS de,
              coalesce(close, 0.0) AS x, coalesce(target, 0.0) AS y
       FROM inner_frame JOIN lead USING (ctm))""", """
mb AS (SELECT min(ds) AS o, max(de) AS m FROM mf)""", """
mi AS (SELECT mf.*, o, m, CAST(floor(datediff('day', o, ds) / 5) AS BIGINT) AS interval FROM mf, mb)""", """
mr AS (SELECT ds, x, y, interval, o + CAST(interval * 5 + 5 AS INTEGER) AS interval_end FROM mi
       WHERE interval >= 0 AND de < o + CAST(interval * 5 + 5 AS INTEGER)
         AND o + CAST(interval * 5 AS INTEGER) < m)""", """
mean AS (SELECT avg(x) AS mx, avg(y) AS my FROM mr)""", """
st AS (SELECT interval, interval_end, count(*) AS n, sum(x - mx) AS sx, sum(y - my) AS sy,
              sum((x - mx) * (x - mx)) AS sxx, sum((x - mx) * (y - my)) AS sxy
       FROM mr, mean GROUP BY 1, 2)""", """
run AS (SELECT interval, interval_end, sum(n) OVER w AS n, sum(sx) OVER w AS sx, sum(sy) OVER w AS sy,
               sum(sxx) OVER w AS sxx, sum(sxy) OVER w AS sxy FROM st WINDOW w AS (ORDER BY interval))""", """
line AS (SELECT interval, interval_end, n, sx, sy, (sxy / n - sx / n * sy / n) / (sxx / n - sx / n * sx / n) AS slope
         FROM run)""", """
model AS (SELECT interval, strftime(interval_end, '%Y-%m-%d') AS the_date, slope,
                 my + sy / n - slope * (mx + sx / n) AS intercept FROM line, mean)""", """
newest AS (SELECT * FROM model ORDER BY the_date DESC LIMIT 1)""", """
scored AS (SELECT strftime(ds, '%Y-%m-%d') AS record_date, interval, the_date, y,
                  greatest(intercept + slope * x, 0.0) AS p FROM mr JOIN model USING (interval))"""]


def _model_ctes() -> list[str]:
    return _inner_frame_ctes() + _MODEL


ORACLE["walk_forward_scores"] = _ctes(_model_ctes()) + \
    f"SELECT record_date, interval, {r4('p')} AS predicted_open FROM scored"

ORACLE["walk_forward_log"] = _ctes(_model_ctes()) + \
    f"SELECT the_date, {r4('avg((p - y) * (p - y))')} AS loss FROM scored GROUP BY 1"

ORACLE["predict_history"] = _ctes(_model_ctes() + _ranged_ctes()[len(_frame_base()):]) + f"""
SELECT strftime(date_start, '%Y-%m-%d') AS record_date,
       {r4('greatest(intercept + slope * coalesce(close, 0.0), 0.0)')} AS predicted_open
FROM ranged, newest"""

ORACLE["registry_resave"] = _ctes(_model_ctes()) + f"""
SELECT the_date, {r4('intercept + 1000')} AS intercept, {r4('slope')} AS w_close FROM newest"""

ORACLE["stream_predictions"] = _ctes([FIXTURE_CTES["stock_lake"]]) + f"""
SELECT strftime(ctm, '%Y-%m-%d') AS record_date, ctm AS candle_time,
       {r4('greatest(1.0 + 0.5 * open - 0.25 * close + 2.0 * 5.0, 0.0)')} AS open
FROM stock_lake"""

# --- refresh, quarantine, restart ---------------------------------------------------
ORACLE["refresh_weather"] = ORACLE["weather_daily"]
ORACLE["refresh_open"] = _ctes([FIXTURE_CTES["stock_lake"]]) + """
SELECT strftime(CAST(substr(date_start, 1, 10) AS DATE), '%Y-%m-%d') AS record_date, open FROM stock_lake"""

ORACLE["envelope_quarantine"] = """
SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'unknown source'
                       ELSE 'payload of another kind' END AS reason, count(*) AS n
FROM events WHERE event_type IN ('error', 'signup', 'click') GROUP BY 1"""

ORACLE["lake_restart"] = _ctes([FIXTURE_CTES["weather_raw"], _WEATHER_LAKE]) + """
SELECT 'scraper_weather_openmeteo' AS source, date_start, date_end, CAST(1 AS BIGINT) AS n_rows FROM weather_lake"""

# --- single operators ---------------------------------------------------------------
ORACLE["recorded_envelopes"] = _ctes([FIXTURE_CTES["weather_raw"], _WEATHER_LAKE]) + \
    f"SELECT {_report_cols(['temperature', 'rain', 'sun', 'date_start', 'date_end'])} FROM weather_lake"

ORACLE["envelope_repair"] = _ctes([FIXTURE_CTES["news_items"]]) + """
SELECT 'scraper_news_' || feed AS source, "date", md5(data) AS data, date_start, date_end FROM news_items"""

ORACLE["weather_upsert"] = ORACLE["weather_daily"]

ORACLE["log_append"] = _ctes([FIXTURE_CTES["scraper_logs"]]) + \
    "SELECT start_date, end_date, record_count FROM scraper_logs"

ORACLE["api_articles"] = _ctes([FIXTURE_CTES["news_items"]]) + """
SELECT md5(data) AS data, "date" FROM news_items
WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND data IS NOT NULL"""

ORACLE["load_windows_5min"] = """
WITH log AS (
  SELECT DISTINCT 'newsapi' AS feed, time_bucket(INTERVAL 5 MINUTE, ts) AS s FROM events WHERE event_type <> 'error'),
w AS (
  SELECT 'newsapi' AS feed, unnest(generate_series((SELECT min(s) FROM log), TIMESTAMP '2024-02-02', INTERVAL 5 MINUTE)) AS s
  UNION ALL
  SELECT 'backup', unnest(generate_series(TIMESTAMP '2024-02-02' - INTERVAL 30 DAY, TIMESTAMP '2024-02-02', INTERVAL 5 MINUTE))),
refused AS (SELECT DISTINCT 'newsapi' AS feed, time_bucket(INTERVAL 5 MINUTE, ts) AS s FROM events
            WHERE event_type = 'error' AND event_id % 2 = 0)
SELECT feed, strftime(s, '%Y-%m-%dT%H:%M:%S') AS start_date,
       strftime(s + INTERVAL 5 MINUTE, '%Y-%m-%dT%H:%M:%S') AS end_date
FROM w WHERE s < TIMESTAMP '2024-02-02' AND NOT EXISTS (SELECT 1 FROM log l WHERE l.feed = w.feed AND l.s = w.s)
  AND NOT EXISTS (SELECT 1 FROM refused r WHERE r.feed = w.feed AND r.s = w.s)"""

ORACLE["last_cursor_12h"] = """
SELECT feed, strftime(t, '%Y-%m-%d %I:%M:%S') AS end_date
FROM (SELECT event_type AS feed, max(date_trunc('day', ts) + to_hours(hour(ts) % 12)) AS t FROM events GROUP BY 1)"""

ORACLE["sentiment_mixed"] = f"""
SELECT day, user_id, part, CAST(n AS BIGINT) AS n_tokens, CAST(p AS BIGINT) AS pos_hits, CAST(g AS BIGINT) AS neg_hits,
       {sql_sentiment('n', 'p', 'g')} AS sentiment
FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, event_id // 1000 AS part, count(*) AS n,
             count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS p,
             count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS g
      FROM events GROUP BY 1, 2, 3)"""
