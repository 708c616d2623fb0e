"""DuckDB SQL that computes the same results as the registered queries.

These strings are independent formulations (windows and unnest where the
Spark plans use array lookups and joins) over the pre-registered views.
"""

from __future__ import annotations

from bellwether import constants as K
from bellwether.functions.text import apostrophe_variants
from bellwether.plans.queries import (FILTER_LABEL as _FILTER_LABEL, FILTER_SOURCES,
                                      INGEST_TIME as _INGEST_TIME, JSON_FIELDS, KEEP_DAYS, LATE_LABEL, LATE_SHARE,
                                      NO_RESULT, EMPTY_RESULT, ODD_EVERY, PAGE_SIZE, PAGES)
from bellwether.sources import tables as TB

_FILTER_SOURCES = ", ".join("'" + s + "'" for s in FILTER_SOURCES)


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _valued(entries) -> list[tuple[str, str]]:
    return [(w, entries[w.replace("’", "'")]) for w in apostrophe_variants(entries)]


def lexicon_values(lexicon=K.DEFAULT_LEXICON) -> str:
    rows = ", ".join(f"({_quote(k)}, CAST({v} AS DECIMAL(8,3)))" for k, v in _valued(lexicon))
    return f"SELECT * FROM (VALUES {rows}) AS t(token, valence)"


def booster_values() -> str:
    rows = ", ".join(f"({_quote(k)}, CAST({v} AS DECIMAL(8,3)))" for k, v in _valued(K.DEFAULT_BOOSTERS))
    return f"SELECT * FROM (VALUES {rows}) AS t(token, inc)"


def negation_values() -> str:
    rows = ", ".join(f"({_quote(k)})" for k in apostrophe_variants(K.DEFAULT_NEGATIONS))
    return f"SELECT * FROM (VALUES {rows}) AS t(token)"


def published_sql(minutes: str) -> str:
    return (f"strftime(TIMESTAMP '{TB.START_TS}' + to_minutes(CAST({minutes} AS BIGINT)), "
            f"'%Y-%m-%d %H:%M:%S')")


HEADLINES = f"""
SELECT doc_id, text AS title, source,
       {published_sql('doc_id')} AS publishedAt,
       '{TB.LINK_PREFIX}' || CAST(doc_id AS VARCHAR) AS link,
       CAST({TB.EPOCH_START} + doc_id * 60 AS DOUBLE) + {TB.FETCH_LAG_SECONDS} AS fetched_at
FROM documents
"""


def scored_sql(headlines_sql: str = HEADLINES, key: str = "doc_id", lexicon=K.DEFAULT_LEXICON) -> str:
    """Score every row of ``headlines_sql`` (unique ``key``, text in ``title``)."""
    pattern = _quote(K.TOKEN_PATTERN)
    contrast = ", ".join(_quote(w) for w in K.CONTRAST_WORDS)
    return f"""
WITH h AS ({headlines_sql}),
lex AS ({lexicon_values(lexicon)}),
boost AS ({booster_values()}),
neg AS ({negation_values()}),
arr AS (
  SELECT {key} AS k, regexp_extract_all(title, {pattern}) AS toks,
         least(length(title) - length(replace(title, '!', '')), {K.EXCLAMATION_LIMIT}) AS marks
  FROM h
),
raw AS (SELECT k, unnest(range(len(toks))) AS pos, unnest(toks) AS raw FROM arr),
tok AS (
  SELECT k, pos, lower(raw) AS t,
         length(raw) > 1 AND raw = upper(raw) AND raw <> lower(raw) AS capital FROM raw
),
ctx AS (
  SELECT k, pos, t, capital,
         lag(t, 1) OVER w AS p1, lag(t, 2) OVER w AS p2, lag(t, 3) OVER w AS p3,
         max(CASE WHEN t IN ({contrast}) THEN pos END) OVER (PARTITION BY k) AS but,
         NOT bool_and(capital) OVER (PARTITION BY k) AS mixed
  FROM tok WINDOW w AS (PARTITION BY k ORDER BY pos)
),
hit AS (
  SELECT ctx.k, ctx.pos, ctx.but, CAST(lex.valence AS DECIMAL(18,6)) AS v,
         {" + ".join(f"CAST(coalesce(b{i + 1}.inc, 0) * CAST({d} AS DECIMAL(3,2)) AS DECIMAL(18,6))"
                     for i, d in enumerate(K.BOOSTER_DAMPING))}
         + CASE WHEN mixed AND capital THEN CAST({K.CAPITALS_INCREMENT} AS DECIMAL(18,6)) ELSE 0 END AS inc,
         (EXISTS (SELECT 1 FROM neg WHERE neg.token IN (ctx.p1, ctx.p2, ctx.p3))) AS negated
  FROM ctx JOIN lex ON lex.token = ctx.t
  {" ".join(f"LEFT JOIN boost b{i} ON b{i}.token = ctx.p{i}" for i in (1, 2, 3))}
),
contrib AS (
  SELECT k, pos, but,
         CAST(v + CASE WHEN v > 0 THEN inc WHEN v < 0 THEN -inc ELSE 0 END AS DECIMAL(18,6)) AS b,
         negated
  FROM hit
),
sums AS (
  SELECT k, sum(CAST(
           CASE WHEN negated THEN CAST(b * CAST({K.NEGATION_SCALAR} AS DECIMAL(8,3)) AS DECIMAL(18,6)) ELSE b END
           * CAST(CASE WHEN but IS NULL THEN 1.0 WHEN pos < but THEN {K.CONTRAST_BEFORE}
                  ELSE {K.CONTRAST_AFTER} END AS DECIMAL(3,1)) AS DECIMAL(18,6))) AS s,
         count(*) AS n_hits
  FROM contrib GROUP BY k
),
total AS (
  SELECT sums.k, n_hits,
         CAST(s + sign(s) * marks * CAST({K.EXCLAMATION_INCREMENT} AS DECIMAL(8,3)) AS DECIMAL(18,6)) AS s
  FROM sums JOIN arr ON arr.k = sums.k
),
comp AS (
  SELECT h.*,
         CASE WHEN h.title IS NULL OR h.title = '' OR total.s IS NULL THEN 0.0
              ELSE CAST(total.s AS DOUBLE) / sqrt(CAST(total.s AS DOUBLE) * CAST(total.s AS DOUBLE)
                                                + {K.NORMALIZATION_ALPHA})
         END AS compound,
         coalesce(total.n_hits, 0) AS n_hits
  FROM h LEFT JOIN total ON total.k = h.{key}
)
SELECT comp.*,
       CASE WHEN compound >= {K.POSITIVE_THRESHOLD} THEN 'Positive'
            WHEN compound <= {K.NEGATIVE_THRESHOLD} THEN 'Negative'
            ELSE 'Neutral' END AS sentiment,
       CAST(compound AS FLOAT) AS confidence
FROM comp
"""


# ---------------------------------------------------------------------------
# Building blocks
# ---------------------------------------------------------------------------
def _cap(col: str) -> str:
    return f"(upper(substr({col}, 1, 1)) || lower(substr({col}, 2)))"


def _round(col: str, places: int) -> str:
    # "+ 0.0" turns a -0.0 into 0.0 (Spark's round never yields -0.0).
    return f"(round(CAST({col} AS DOUBLE), {places}) + 0.0)"


def _fmt(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _esc(col: str) -> str:
    return f"replace(replace(replace({col}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


HEADLINES_LANG = HEADLINES.replace("SELECT doc_id, text AS title", "SELECT doc_id, lang, text AS title")

SCORED = scored_sql()
GRADED = scored_sql(lexicon=K.GRADED_LEXICON)


def served_sql(scored: str) -> str:
    return f"""
SELECT title, source, publishedAt, {_cap('sentiment')} AS sentiment,
       {_round('confidence', K.STORED_DECIMALS)} AS confidence, link
FROM ({scored})
"""


SERVED = served_sql(SCORED)
GRADED_SERVED = served_sql(GRADED)

RECORDS = f"""
WITH s AS ({scored_sql(HEADLINES_LANG)}),
f AS (SELECT s.*, 0 AS fetch_no FROM s UNION ALL SELECT s.*, 1 AS fetch_no FROM s)
SELECT fetch_no AS partition, doc_id AS "offset", title,
       CASE WHEN lang <> '{TB.NO_SOURCE_LANG}' THEN source END AS source,
       publishedAt, link, fetched_at + fetch_no * {TB.REFETCH_SECONDS} AS fetched_at,
       CASE WHEN doc_id % {TB.BAD_LABEL_EVERY} = {TB.EMPTY_LABEL} THEN ''
            WHEN doc_id % {TB.BAD_LABEL_EVERY} <> {TB.NO_LABEL} THEN sentiment END AS sentiment, confidence,
       make_timestamp(CAST(trunc(fetched_at + fetch_no * {TB.REFETCH_SECONDS}) AS BIGINT) * 1000000)
         AS fetched_at_ts
FROM f
"""

# The same with every document's label kept: its message without one is a further record of a third partition.
LABELLED_RECORDS = f"""
WITH s AS ({scored_sql(HEADLINES_LANG, lexicon=K.GRADED_LEXICON)}),
f AS (SELECT s.*, 0 AS fetch_no, sentiment AS label FROM s UNION ALL SELECT s.*, 1, sentiment FROM s
      UNION ALL SELECT s.*, 2, '' FROM s WHERE doc_id % {TB.BAD_LABEL_EVERY} = {TB.EMPTY_LABEL}
      UNION ALL SELECT s.*, 2, NULL FROM s WHERE doc_id % {TB.BAD_LABEL_EVERY} = {TB.NO_LABEL})
SELECT fetch_no AS partition, doc_id AS "offset", title,
       CASE WHEN lang <> '{TB.NO_SOURCE_LANG}' THEN source END AS source,
       publishedAt, link, fetched_at + fetch_no * {TB.REFETCH_SECONDS} AS fetched_at, label AS sentiment, confidence,
       make_timestamp(CAST(trunc(fetched_at + fetch_no * {TB.REFETCH_SECONDS}) AS BIGINT) * 1000000)
         AS fetched_at_ts
FROM f
"""

RECORD_FIELDS = ("title, source, publishedAt, link, fetched_at, sentiment, "
                 f"confidence, {_fmt('fetched_at_ts')} AS fetched_at_ts")
RECORD_COLS = f'partition, "offset", {RECORD_FIELDS}'

REQUIRED = " AND ".join(f"{k} IS NOT NULL" for k in K.REQUIRED_KEYS)

LATEST = f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY partition, "offset") - 1 AS idx,
                  ({REQUIRED}) AS valid FROM ({RECORDS}))
SELECT * FROM r
WHERE valid AND (idx < {K.LATEST_CAP}
                 OR idx = (SELECT min(idx) FROM r WHERE valid AND idx >= {K.LATEST_CAP}))
"""

EVENTS = "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events"

# Events in three batches (earlier, later, late copies), each with the watermark of the batches before it.
BATCHED = f"""
WITH e AS (SELECT *, (SELECT max(event_id) FROM events) AS last FROM ({EVENTS})),
b AS (SELECT *, CASE WHEN event_id * 2 < last THEN 1 ELSE 2 END AS batch FROM e
      UNION ALL SELECT *, 3 AS batch FROM e WHERE event_type = '{LATE_LABEL}' AND event_id < last * {LATE_SHARE})
SELECT *, (SELECT max(p.ts) FROM b p WHERE p.batch < b.batch) - INTERVAL {K.WATERMARK_DELAY} AS mark FROM b
"""

ARTICLES = f"""
WITH a AS (
  SELECT conv_id, CAST(floor(turn / {K.PAGE_SIZE}) AS INTEGER) AS page, turn, role,
         text AS title,
         CASE WHEN turn <> 3 THEN '{TB.CONV_LINK_PREFIX}' || CAST(conv_id AS VARCHAR) || '/'
              || CAST(turn AS VARCHAR) END AS url,
         CASE WHEN turn = 0 THEN strftime(pts, '%Y-%m-%d')
              ELSE strftime(pts, '%Y-%m-%dT%H:%M:%SZ') END AS publishedAt,
         CASE WHEN turn IN (1, 2) THEN NULL ELSE role END AS source_name,
         (turn = 1) AS source_missing
  FROM (SELECT *, TIMESTAMP '{TB.START_TS}' + to_hours(CAST(conv_id AS BIGINT))
                  + to_minutes(CAST(turn AS BIGINT)) AS pts FROM conversations)
),
env AS (SELECT conv_id, page, bool_or(role = 'system') AS failed FROM a GROUP BY conv_id, page)
SELECT CASE copy WHEN 0 THEN 'c' ELSE 'd' END || CAST(a.conv_id AS VARCHAR) AS country,
       CAST(a.conv_id + copy * {TB.SECOND_RANK} AS BIGINT) AS country_rank, a.page,
       CAST(row_number() OVER (PARTITION BY a.conv_id, a.page, copy ORDER BY a.turn) - 1 AS INTEGER) AS pos,
       title, url, publishedAt, source_name, source_missing
FROM a JOIN env ON env.conv_id = a.conv_id AND env.page = a.page
JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR a.conv_id % {TB.REPEAT_EVERY} = 0
WHERE NOT env.failed
"""

FLAT_COLS = "country, country_rank, page, pos, title, url, publishedAt, source_name, source_missing"

DEDUPED_ARTICLES = f"""
SELECT * FROM ({ARTICLES})
QUALIFY row_number() OVER (PARTITION BY title ORDER BY country_rank, page, pos) = 1
"""

NORMALISED = f"""
SELECT country_rank, page, pos, title,
       coalesce(source_name, '{K.UNKNOWN_SOURCE}') AS source,
       strftime(try_strptime(publishedAt, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS publishedAt,
       coalesce(url, '') AS link,
       CAST({_INGEST_TIME} AS DOUBLE) AS fetched_at,
       CASE WHEN publishedAt IS NULL THEN 'missing publishedAt'
            WHEN try_strptime(publishedAt, '%Y-%m-%dT%H:%M:%SZ') IS NULL THEN 'unparsable publishedAt'
            WHEN source_missing THEN 'missing source' END AS reject_reason
FROM ({DEDUPED_ARTICLES})
"""

def _trend(source_sql: str, label: str, scale: int) -> str:
    # Spark's sum of DECIMAL(12, s) is DECIMAL(22, s); DuckDB widens to 38.
    return f"""
SELECT {_fmt('date_trunc(\'hour\', ts)')} AS window_start,
       {_fmt('date_trunc(\'hour\', ts) + INTERVAL 1 HOUR')} AS window_end,
       {label}, count(*) AS n, CAST(sum(value) AS DECIMAL(22, {scale})) AS sum_value,
       CAST(sum(value) AS DOUBLE) / count(*) AS avg_value
FROM ({source_sql}) GROUP BY ALL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "score_headlines": f"""SELECT doc_id, title, source, publishedAt, link, fetched_at,
            sentiment, confidence, compound, n_hits FROM ({GRADED})""",
        "sentiment_counts": f"""
            WITH lab(sentiment, label_rank) AS (VALUES ('Positive', 1), ('Negative', 2), ('Neutral', 3)),
            c AS (SELECT {_cap('sentiment')} AS sentiment, count(*) AS n FROM ({SCORED}) GROUP BY 1)
            SELECT lab.sentiment, CAST(lab.label_rank AS INTEGER) AS label_rank,
                   coalesce(c.n, 0) AS n
            FROM lab LEFT JOIN c ON c.sentiment = lab.sentiment ORDER BY label_rank""",
        "latest_cards": f"""
            WITH s AS (SELECT *, TRY_CAST(publishedAt AS TIMESTAMP) AS pts FROM ({SERVED}))
            SELECT row_number() OVER (PARTITION BY CAST(pts AS DATE) ORDER BY pts DESC, title, link) AS rank_in_day,
                   title, source, publishedAt, {_fmt('pts')} AS published_ts, sentiment, confidence, link,
                   '**' || {_esc('title')} || '**  ' || chr(10) ||
                   '_Source_: ' || {_esc('source')} || '  ' || chr(10) ||
                   '_Published at_: ' || coalesce({_fmt('pts')}, 'NaT') || '  ' || chr(10) ||
                   '_Sentiment_: ' || sentiment || ' (' ||
                   printf('%.{K.CARD_DECIMALS}f', {_round('confidence', K.CARD_DECIMALS)}) || ')  ' || chr(10) ||
                   '[Link to article](' || {_esc('link')} || ')' AS card
            FROM s ORDER BY pts DESC NULLS LAST, title, link""",
        "sentiment_json": f"""
            SELECT doc_id, false AS is_null, sentiment, confidence FROM ({GRADED})
            UNION ALL
            SELECT doc_id, true, NULL, NULL FROM documents
            WHERE doc_id % {TB.BAD_LABEL_EVERY} IN ({EMPTY_RESULT}, {NO_RESULT})""",
        "json_output": f"""
            SELECT partition, "offset", concat_ws(',', {", ".join(
                f"CASE WHEN {c} IS NOT NULL THEN '{c}' END" for c in JSON_FIELDS)}) AS keys, {RECORD_FIELDS}
            FROM ({RECORDS})""",
        "oldest_first": f"""
            SELECT row_number() OVER (PARTITION BY substr(publishedAt, 1, 10) ORDER BY publishedAt, title, link)
                   AS rank_in_day, * FROM ({GRADED_SERVED}) ORDER BY publishedAt NULLS LAST, title, link""",
        "filter_sentiment_source": f"""SELECT * FROM ({GRADED_SERVED})
            WHERE sentiment = '{_FILTER_LABEL}' AND source IN ({_FILTER_SOURCES})""",
        "filtered_count": f"""SELECT count(*) AS n_rows FROM ({SERVED})
            WHERE sentiment = '{_FILTER_LABEL}' AND source IN ({_FILTER_SOURCES})""",
        "reconcile_columns": f"""SELECT title, source, publishedAt, sentiment,
            CAST(NULL AS DOUBLE) AS confidence, '' AS link FROM ({SCORED})""",
        "scored_projection": f"SELECT {RECORD_COLS} FROM ({RECORDS})",
        "required_keys": f"SELECT {RECORD_COLS} FROM ({LABELLED_RECORDS}) WHERE {REQUIRED}",
        "bad_sentiment": f"""SELECT partition, "offset", title, sentiment FROM ({RECORDS})
            WHERE sentiment IS NULL OR sentiment = ''""",
        "dedupe_title_published": f"""
            SELECT partition, "offset", title, source, publishedAt, {_cap('sentiment')} AS sentiment,
                   {_round('confidence', K.STORED_DECIMALS)} AS confidence, link
            FROM ({RECORDS}) WHERE {REQUIRED}
            QUALIFY row_number() OVER (PARTITION BY title, publishedAt ORDER BY "offset", partition) = 1""",
        "distinct_sources": f"""SELECT source, min("offset") AS first_seen FROM ({RECORDS})
            GROUP BY source ORDER BY first_seen, source""",
        "scored_retention": f"""SELECT {RECORD_COLS} FROM ({RECORDS})
            WHERE fetched_at_ts >= (SELECT max(fetched_at_ts) FROM ({RECORDS})) - INTERVAL {K.SCORED_RETENTION}""",
        "capped_take": f"SELECT idx, {RECORD_COLS} FROM ({LATEST})",
        "latest_counts": f"""
            WITH lab(sentiment, label_rank) AS (VALUES ('Positive', 1), ('Negative', 2), ('Neutral', 3)),
            c AS (SELECT {_cap('sentiment')} AS sentiment, count(*) AS n FROM ({LATEST}) GROUP BY 1)
            SELECT lab.sentiment, CAST(lab.label_rank AS INTEGER) AS label_rank,
                   coalesce(c.n, 0) AS n
            FROM lab LEFT JOIN c ON c.sentiment = lab.sentiment ORDER BY label_rank""",
        "flatten_envelope": f"SELECT {FLAT_COLS} FROM ({ARTICLES})",
        "dedupe_first_title": f"SELECT {FLAT_COLS} FROM ({DEDUPED_ARTICLES})",
        "dedupe_page_titles": f"""
            SELECT pos, title, url FROM (
              SELECT page_id AS pos,
                     nullif(regexp_extract(html, '{TB.TITLE_PATTERN}', 1), '') AS title, url
              FROM pages)
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY pos) = 1""",
        "normalise_articles": NORMALISED,
        "quarantine_split": f"SELECT * FROM ({NORMALISED}) WHERE reject_reason IS NOT NULL",
        "union_batches": f"""
            SELECT title, source, publishedAt, link, fetched_at FROM ({HEADLINES})
            UNION ALL
            SELECT title, source, publishedAt, link, fetched_at FROM ({NORMALISED})
            WHERE reject_reason IS NULL""",
        "batch_metrics": f"""
            SELECT (SELECT count(*) FROM ({ARTICLES})) AS n_fetched,
                   (SELECT count(*) FROM ({DEDUPED_ARTICLES})) AS n_unique,
                   (SELECT count(*) FROM ({NORMALISED}) WHERE reject_reason IS NULL) AS n_sent,
                   (SELECT count(*) FROM ({NORMALISED}) WHERE reject_reason IS NOT NULL) AS n_rejected""",
        "parse_json_props": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
            FROM events""",
        "iso_normalise": f"""
            SELECT event_id, iso_in,
                   strftime(try_strptime(iso_in, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS display
            FROM (SELECT event_id,
                         CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
                              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso_in
                  FROM ({EVENTS}))""",
        "epoch_to_ts": f"""
            SELECT event_id, epoch,
                   {_fmt('make_timestamp(CAST(trunc(epoch) AS BIGINT) * 1000000)')} AS ts_whole
            FROM (SELECT event_id, epoch_us(ts) / 1000000.0 AS epoch FROM ({EVENTS}))""",
        "lenient_ts": f"""
            SELECT event_id, raw, {_fmt('TRY_CAST(raw AS TIMESTAMP)')} AS parsed
            FROM (SELECT event_id,
                         CASE WHEN event_type = 'error' THEN props ELSE {_fmt('ts')} END AS raw
                  FROM ({EVENTS}))""",
        "retention_window": f"""
            SELECT event_id, {_fmt('ts')} AS ts, event_type FROM ({EVENTS})
            WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {K.RAW_RETENTION}""",
        "today_partition": f"""
            SELECT event_id, {_fmt('ts')} AS ts FROM ({EVENTS})
            WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""",
        "sentiment_trend": _trend(
            f"""SELECT TRY_CAST(publishedAt AS TIMESTAMP) AS ts, sentiment,
                       CAST(confidence AS DECIMAL(12,3)) AS value FROM ({GRADED_SERVED})""", "sentiment", 3),
        "event_trend": _trend(
            f"SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM ({EVENTS})",
            "event_type", 2),
        "stream_history": SERVED,
        "stream_dedupe": f"""
            SELECT DISTINCT title, source, publishedAt, {_cap('sentiment')} AS sentiment,
                   {_round('confidence', K.STORED_DECIMALS)} AS confidence, link
            FROM ({RECORDS}) WHERE {REQUIRED}""",
        "stream_trend": f"""
            SELECT * FROM ({_trend(
                f"SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM ({EVENTS})",
                "event_type", 2)})
            WHERE window_end <= {_fmt(f"(SELECT max(ts) FROM ({EVENTS})) - INTERVAL {K.WATERMARK_DELAY}")}""",
        "stream_late_rows": f"""
            WITH e AS (SELECT *, (SELECT max(event_id) FROM events) AS last FROM ({EVENTS})),
            late AS (SELECT DISTINCT date_trunc('hour', ts), event_type FROM e
                     WHERE event_type = '{LATE_LABEL}' AND event_id < last * {LATE_SHARE})
            SELECT t.*, (SELECT count(*) FROM late) AS rows_dropped FROM ({_trend(
                f"SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM ({EVENTS})",
                "event_type", 2)}) t
            WHERE window_end <= {_fmt(f"(SELECT max(ts) FROM ({EVENTS})) - INTERVAL {K.WATERMARK_DELAY}")}""",
        "history_facets": f"""
            SELECT substr(publishedAt, 1, 10) AS day, source, {_cap('sentiment')} AS sentiment, count(*) AS n,
                   min("offset") AS first_seen
            FROM (SELECT * FROM ({RECORDS}) WHERE {REQUIRED}
                  QUALIFY row_number() OVER (PARTITION BY title, publishedAt ORDER BY "offset", partition) = 1)
            GROUP BY ALL""",
        "stream_open_trend": _trend(
            f"SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM ({EVENTS})", "event_type", 2),
        "stream_late_split": f"""
            SELECT event_id, {_fmt('ts')} AS ts, event_type, CAST(value AS DECIMAL(12,2)) AS value,
                   {_fmt('mark')} AS late_watermark
            FROM ({BATCHED}) WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark""",
        "stream_trend_merged": _trend(
            f"SELECT ts, event_type, CAST(value AS DECIMAL(12,2)) AS value FROM ({BATCHED})", "event_type", 2),
        "card_pages": f"""
            SELECT title, source, publishedAt, sentiment, confidence, link, {_fmt('pts')} AS published_ts,
                   CAST((place - 1) // {PAGE_SIZE} + 1 AS INTEGER) AS page
            FROM (SELECT *, row_number() OVER (ORDER BY pts DESC NULLS LAST, title, link, publishedAt) AS place
                  FROM (SELECT *, TRY_CAST(publishedAt AS TIMESTAMP) AS pts FROM ({SERVED})))
            WHERE place <= {PAGES * PAGE_SIZE}""",
        "field_violations": f"""
            WITH m AS (
              SELECT doc_id, CASE doc_id % {ODD_EVERY} WHEN 1 THEN '"x"' WHEN 2 THEN '{{"at":[1,2]}}' WHEN 3 THEN 'true'
                       WHEN 4 THEN 'null' WHEN 5 THEN '[1.5]' END AS fetched FROM ({HEADLINES}))
            SELECT doc_id, 'fetched_at' AS field, 'double' AS expected,
                   CASE json_type(fetched) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
                        WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS found,
                   CASE json_type(fetched) WHEN 'VARCHAR' THEN json_extract_string(fetched, '$') ELSE fetched END AS value
            FROM m WHERE json_type(fetched) NOT IN ('NULL', 'DOUBLE', 'UBIGINT', 'BIGINT')""",
        "history_expiry": f"""
            SELECT event_id, event_type, {_fmt('ts')} AS ts, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS n_day
            FROM ({EVENTS}) WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) FROM events) - {KEEP_DAYS}""",
    }
