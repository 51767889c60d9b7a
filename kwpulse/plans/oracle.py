"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the reference's semantics in its own forms (two-window join for
growth, two cumulative scans for the backtest, four metric scans, ...), not
transcribed from the Spark plans. Views ``events customer documents
conversations benchmark`` are registered by the checker.
"""

from __future__ import annotations

import datetime as _dt

from kwpulse.functions import dims
from kwpulse.functions.exprs import TOKEN_PATTERN
from kwpulse.plans import params as P
from kwpulse.schemas import STAT_FIELDS


# Stated here anew, not taken from the code under test.
WINDOW_HOURS = {"hourly": 1, "daily": 24, "weekly": 168}
METRIC_NAMES = ("videos_processed_last_24h", "keywords_extracted_last_24h", "unique_keywords_last_24h", "rows_missing_stats")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ts(t: _dt.datetime) -> str:
    return f"TIMESTAMP '{t.strftime('%Y-%m-%d %H:%M:%S')}'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _stat(field: str) -> str:
    return (f"TRY_CAST(CASE WHEN json_valid(stats) THEN json_extract_string(stats, '$.{field}') END "
            f"AS BIGINT)")


NATION_CODES = dims.sql_values(list(enumerate(dims.TPCH_NATION_CODES)), ["nationkey", "code"], "nc")
ISO = dims.sql_values(sorted(dims.ISO_ALPHA2_TO_ALPHA3.items()), ["alpha2", "alpha3"], "iso")
SW = dims.sql_values(dims.stopword_rows(), ["lang", "word"])

_PLAY = "CAST(CASE WHEN e.event_id % 19 = 0 THEN 0 ELSE e.event_id * 13 % 9000 + 1000 END AS VARCHAR)"

KW = f"""kw AS (
  SELECT CAST(e.user_id AS VARCHAR) AS video_id,
         'k' || json_extract_string(e.props, '$.k') AS keyword,
         e.event_type AS modality,
         CAST(1.0 AS DOUBLE) AS confidence,
         e.ts AS detected_at,
         CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE e.ts END AS posted_at,
         CASE WHEN e.event_id % 31 = 0 THEN NULL
              WHEN e.event_id % 53 = 0 THEN ' ' || lower(nc.code) || ' '
              ELSE nc.code END AS region,
         CASE WHEN e.event_id % 37 = 0 THEN NULL ELSE c.c_mktsegment END AS category,
         CASE WHEN e.event_id % 41 = 0 THEN NULL
              WHEN e.event_id % 43 = 0 THEN 'not json'
              WHEN e.event_id % 47 = 0 THEN '{{}}'
              ELSE '{{"diggCount":' || CAST(e.event_id * 7 % 1000 AS VARCHAR)
                || ',"commentCount":' || CAST(e.event_id * 3 % 100 AS VARCHAR)
                || ',"shareCount":' || CAST(e.event_id % 50 AS VARCHAR)
                || ',"collectCount":' || CAST(e.event_id % 70 AS VARCHAR)
                || ',"playCount":' || CASE WHEN e.event_id % 59 = 0 THEN '"' || {_PLAY} || '"'
                                           ELSE {_PLAY} END
                || '}}' END AS stats
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN {NATION_CODES} ON c.c_nationkey = nc.nationkey)"""

_COUNTS = ",\n         ".join(f"COALESCE({_stat(f)}, 0) AS {f}" for f in STAT_FIELDS)

CLEAN = KW + f""",
counts AS (
  SELECT kw.*,
         {_COUNTS}
  FROM kw),
tot AS (SELECT *, diggCount + commentCount + shareCount + collectCount AS engagement_total FROM counts),
clean AS (
  SELECT *,
         CASE WHEN playCount > 0 THEN engagement_total / playCount ELSE 0.0 END AS engagement_rate,
         CASE WHEN playCount > 0 THEN shareCount / playCount ELSE 0.0 END AS virality_index,
         CASE WHEN playCount > 0 THEN commentCount / playCount ELSE 0.0 END AS discussion_rate,
         CASE WHEN playCount > 0 THEN collectCount / playCount ELSE 0.0 END AS save_rate
  FROM tot)"""

DASH = CLEAN + f""",
dash0 AS (SELECT * REPLACE (COALESCE(upper(trim(region)), 'UNKNOWN') AS region) FROM clean),
dash AS (SELECT d.*, iso.alpha3 AS iso3 FROM dash0 d LEFT JOIN {ISO} ON d.region = iso.alpha2)"""

CLEAN_COLUMNS = ["video_id", "keyword", "modality", "confidence", "detected_at", "posted_at",
                 "region", "category", "stats"] + STAT_FIELDS + [
    "engagement_total", "engagement_rate", "virality_index", "discussion_rate", "save_rate"]
DASH_COLUMNS = CLEAN_COLUMNS + ["iso3"]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- growth family

def growth_sql(time_window: str, threshold: float, region=None, category=None,
               min_likes=0, min_comments=0, min_shares=0, min_views=0, limit=20) -> str:
    period = _dt.timedelta(hours=WINDOW_HOURS[time_window])
    lo, mid, hi = P.AS_OF - 2 * period, P.AS_OF - period, P.AS_OF

    def side(a, b):
        cond = [f"detected_at >= {_ts(a)}", f"detected_at < {_ts(b)}",
                f"{_stat('diggCount')} >= {min_likes}", f"{_stat('commentCount')} >= {min_comments}",
                f"{_stat('shareCount')} >= {min_shares}", f"{_stat('playCount')} >= {min_views}"]
        if region:
            cond.append(f"region = {_q(region)}")
        if category:
            cond.append(f"category = {_q(category)}")
        return (f"SELECT keyword, region, category, CAST(count(*) AS DOUBLE) AS mentions FROM kw "
                f"WHERE {' AND '.join(cond)} GROUP BY keyword, region, category")

    lim = f"LIMIT {limit}" if limit else ""
    return _with(KW, f"prev AS ({side(lo, mid)})", f"curr AS ({side(mid, hi)})") + f"""
, j AS (
  SELECT c.keyword, c.region, c.category, c.mentions AS current_mentions,
         COALESCE(p.mentions, CAST(0 AS DOUBLE)) AS prev_mentions
  FROM curr c LEFT JOIN prev p
    ON c.keyword = p.keyword AND c.region = p.region AND c.category = p.category),
g AS (
  SELECT *, CASE WHEN prev_mentions = 0 AND current_mentions > 1 THEN CAST(999.0 AS DOUBLE)
                 WHEN prev_mentions = 0 THEN CAST(0.0 AS DOUBLE)
                 ELSE (current_mentions - prev_mentions) / prev_mentions END AS growth_rate
  FROM j)
SELECT keyword, region, category, current_mentions, prev_mentions, growth_rate FROM g
WHERE growth_rate >= {float(threshold)}
ORDER BY growth_rate DESC, keyword ASC NULLS FIRST, region ASC NULLS FIRST, category ASC NULLS FIRST
{lim}"""


def catch_up_sql(first, last, time_window, threshold, limit, min_likes=0, min_comments=0, min_shares=0, min_views=0) -> str:
    """A row of ``runs`` for each run; both windows of each by a range join."""
    hours = f"INTERVAL {WINDOW_HOURS[time_window]} HOUR"
    cond = (f"{_stat('diggCount')} >= {min_likes} AND {_stat('commentCount')} >= {min_comments} "
            f"AND {_stat('shareCount')} >= {min_shares} AND {_stat('playCount')} >= {min_views}")

    def side(start, end):
        return (f"SELECT run, keyword, region, category, CAST(count(*) AS DOUBLE) AS mentions FROM fit JOIN runs "
                f"ON detected_at >= run - {start} AND detected_at < run - {end} GROUP BY ALL")

    return _with(KW, f"runs AS (SELECT unnest(generate_series({_ts(first)}, {_ts(last)}, {hours})) AS run)",
                 f"fit AS (SELECT * FROM kw WHERE {cond})", f"prev AS ({side(f'2 * {hours}', hours)})",
                 f"curr AS ({side(hours, 'INTERVAL 0 HOUR')})") + f"""
, j AS (
  SELECT c.*, COALESCE(p.mentions, CAST(0 AS DOUBLE)) AS before
  FROM curr c LEFT JOIN prev p
    ON c.run = p.run AND c.keyword = p.keyword AND c.region = p.region AND c.category = p.category),
g AS (
  SELECT *, CASE WHEN before = 0 AND mentions > 1 THEN CAST(999.0 AS DOUBLE)
                 WHEN before = 0 THEN CAST(0.0 AS DOUBLE) ELSE (mentions - before) / before END AS rate FROM j)
SELECT run AS time_bucket, keyword, region, category, mentions AS current_mentions, before AS prev_mentions,
       rate AS growth_rate, CAST(row_number() OVER (PARTITION BY run ORDER BY rate DESC, keyword ASC NULLS FIRST,
         region ASC NULLS FIRST, category ASC NULLS FIRST) AS INTEGER) AS rank
FROM g WHERE rate >= {float(threshold)} QUALIFY rank <= {limit}"""


def growth_rows_sql(time_window: str, **kw) -> str:
    inner = growth_sql(time_window, **kw)
    return f"""SELECT keyword, region, category, {_ts(P.AS_OF)} AS time_bucket,
  CAST(current_mentions AS INTEGER) AS mentions, growth_rate, {_q(time_window)} AS time_window,
  {_ts(P.AS_OF)} AS detected_at
FROM ({inner}) r"""


def backtest_sql(days_back=7, horizon_days=3) -> str:
    t0 = P.AS_OF - _dt.timedelta(days=days_back)
    t1 = t0 + _dt.timedelta(days=horizon_days)
    return _with(KW) + f"""
, base AS (SELECT keyword, count(*) AS n FROM kw WHERE detected_at <= {_ts(t0)} GROUP BY keyword),
fut AS (SELECT keyword, count(*) AS n FROM kw WHERE detected_at <= {_ts(t1)} GROUP BY keyword)
SELECT b.keyword, b.n AS count_then, COALESCE(f.n, b.n) AS count_future,
       (COALESCE(f.n, b.n) - b.n) / greatest(b.n, 1) AS growth
FROM base b LEFT JOIN fut f ON b.keyword = f.keyword"""


def metrics_sql(as_of: _dt.datetime = P.AS_OF) -> str:
    lo = _ts(as_of - _dt.timedelta(days=1))
    vals = [f"(SELECT count(DISTINCT video_id) FROM kw WHERE detected_at >= {lo})",
            f"(SELECT count(*) FROM kw WHERE detected_at >= {lo})",
            f"(SELECT count(DISTINCT keyword) FROM kw WHERE detected_at >= {lo})",
            "(SELECT count(*) FROM kw WHERE stats IS NULL)"]
    rows = "\nUNION ALL ".join(
        f"SELECT {_q(n)} AS metric_name, CAST({v} AS DOUBLE) AS metric_value, {_ts(as_of)} AS metric_time"
        for n, v in zip(METRIC_NAMES, vals))
    return _with(KW) + rows


HOURLY_BODY = """SELECT date_trunc('hour', posted_at) AS bucket, keyword, region, category,
       count(*) AS mentions
FROM kw {where} GROUP BY 1, 2, 3, 4"""


# ---------------------------------------------------------------- text family

def texts_cte(sources=("documents", "conversations", "benchmark")) -> str:
    parts = []
    if "documents" in sources:
        parts.append("SELECT CAST(doc_id AS VARCHAR) AS video_id, 'caption' AS modality, "
                     "CAST(NULL AS BIGINT) AS frame, text FROM documents")
    if "conversations" in sources:
        parts.append("SELECT CAST(conv_id AS VARCHAR) AS video_id, role AS modality, "
                     "CAST(turn AS BIGINT) AS frame, text FROM conversations")
    if "benchmark" in sources:
        parts.append("SELECT CAST(item_id AS VARCHAR) AS video_id, 'ocr' AS modality, "
                     "CAST(NULL AS BIGINT) AS frame, text FROM benchmark")
    return "texts AS (SELECT *, COALESCE(frame, -1) AS frame_k FROM (" + " UNION ALL ".join(parts) + "))"


def keyword_ctes(src: str, keys: list[str], top_k: int = 20, stopwords: str = f"SELECT * FROM {SW}") -> list[str]:
    k = ", ".join(keys)
    fk = ", ".join(f"f.{c}" for c in keys)
    on = " AND ".join(f"f.{c} = l.{c}" for c in keys)
    pat = _q(TOKEN_PATTERN)
    return [
        f"sw AS ({stopwords})",
        f"tok AS (SELECT * FROM (SELECT {k}, unnest(l) AS token, generate_subscripts(l, 1) AS pos "
        f"FROM (SELECT {k}, regexp_extract_all(lower(text), {pat}) AS l FROM {src})) "
        f"WHERE NOT regexp_full_match(token, '[0-9]+'))",
        f"freq AS (SELECT {k}, token, count(*) AS freq, min(pos) AS first_pos FROM tok GROUP BY {k}, token)",
        f"hits AS (SELECT {fk}, sw.lang, sum(f.freq) AS hits FROM freq f JOIN sw ON f.token = sw.word "
        f"GROUP BY {fk}, sw.lang)",
        f"lang AS (SELECT {k}, lang FROM (SELECT *, row_number() OVER (PARTITION BY {k} "
        f"ORDER BY hits DESC, lang ASC) AS rn FROM hits) WHERE rn = 1)",
        f"kept AS (SELECT f.*, COALESCE(l.lang, 'en') AS lang FROM freq f LEFT JOIN lang l ON {on} "
        f"WHERE NOT regexp_full_match(f.token, '[0-9]+'))",
        "ns AS (SELECT * FROM kept k WHERE NOT EXISTS "
        "(SELECT 1 FROM sw WHERE sw.lang = k.lang AND sw.word = k.token))",
        f"top AS (SELECT {k}, token AS keyword, rn AS rank FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {k} ORDER BY freq DESC, first_pos ASC) AS rn FROM ns) WHERE rn <= {top_k})",
    ]


_CATS = "[" + ", ".join(_q(c) for c in dims.COLLECTOR_CATEGORIES) + "]"

VIDEOS = f"""vp AS (
  SELECT doc_id AS entry_id, text, lang, source,
    CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS id,
    CASE WHEN doc_id % 7 = 0 OR doc_id % 13 = 0 THEN text END AS caption,
    CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS desc_,
    CASE WHEN doc_id % 9 = 0 THEN NULL
         ELSE CASE lang WHEN 'en' THEN 'US' WHEN 'de' THEN 'DE' WHEN 'fr' THEN 'FR'
                        WHEN 'es' THEN 'ES' ELSE upper(lang) END END AS region,
    CASE WHEN doc_id % 8 = 0 THEN '' ELSE {_CATS}[doc_id % {len(dims.COLLECTOR_CATEGORIES)} + 1] END AS category,
    CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '0' WHEN doc_id % 29 = 0 THEN 'abc'
         ELSE CAST(1704067200 + doc_id * 3600 AS VARCHAR) END AS createTime,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE source END AS music_title,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN upper(lang) END AS music_author,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS music_authorName,
    CASE WHEN doc_id % 10 = 0 THEN NULL
         ELSE '{{"collectCount":' || CAST(doc_id % 70 AS VARCHAR)
           || ',"commentCount":' || CAST(doc_id * 3 % 100 AS VARCHAR)
           || ',"diggCount":' || CAST(doc_id * 7 % 1000 AS VARCHAR)
           || ',"playCount":' || CAST(doc_id * 13 % 9000 AS VARCHAR)
           || ',"shareCount":' || CAST(doc_id % 50 AS VARCHAR) || '}}' END AS stats_raw,
    CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'v' || CAST(doc_id AS VARCHAR) END AS video_inner_id,
    'https://video.invalid/' || CAST(doc_id AS VARCHAR) AS video_play_addr,
    CAST(1704067200 + doc_id * 60 AS VARCHAR) AS video_create_time,
    'user' || CAST(doc_id % 97 AS VARCHAR) AS author_unique_id
  FROM documents)"""

RECORDS = f"""rec AS (
  SELECT entry_id,
    COALESCE(NULLIF(id, ''), NULLIF(video_inner_id, ''), 'unknown') AS video_id,
    COALESCE(NULLIF(region, ''), 'unknown') AS region,
    NULLIF(category, '') AS category,
    COALESCE(stats_raw, '{{}}') AS stats,
    {_ts(P.AS_OF)} AS detected_at,
    COALESCE(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(TRY_CAST(COALESCE(
        NULLIF(NULLIF(createTime, ''), '0'), NULLIF(NULLIF(video_create_time, ''), '0')) AS BIGINT)),
      {_ts(P.AS_OF)}) AS posted_at
  FROM vp)"""

SOURCES = """src AS (
  SELECT entry_id, 'caption' AS modality, CAST(NULL AS BIGINT) AS frame, -1 AS frame_k,
         COALESCE(NULLIF(desc_, ''), NULLIF(caption, '')) AS text FROM vp
  WHERE COALESCE(NULLIF(desc_, ''), NULLIF(caption, '')) IS NOT NULL
  UNION ALL
  SELECT entry_id, 'music', CAST(NULL AS BIGINT), -1, m FROM (
    SELECT entry_id, concat_ws(' ', NULLIF(music_title, ''),
                               COALESCE(NULLIF(music_authorName, ''), NULLIF(music_author, ''))) AS m
    FROM vp) WHERE trim(m) <> '')"""


def _sum(c: str, alias: str) -> str:
    return f"CAST(sum({c}) AS BIGINT) AS {alias}"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    cc = ", ".join(CLEAN_COLUMNS)

    # --- sources / derivations
    q["kw_facts"] = _with(KW) + "SELECT * FROM kw"
    q["stats_expand"] = _with(CLEAN) + ("SELECT video_id, keyword, modality, detected_at, stats, "
                                        + ", ".join(STAT_FIELDS) + " FROM clean")
    q["kpis"] = _with(CLEAN) + f"SELECT {cc} FROM clean"
    q["clean_load"] = _with(DASH) + "SELECT * FROM dash"
    q["csv_roundtrip"] = _with(KW) + "SELECT * FROM kw"
    q["region_norm"] = _with(KW) + ("SELECT region AS region_raw, COALESCE(upper(trim(region)), 'UNKNOWN') "
                                    "AS region, count(*) AS rows FROM kw GROUP BY 1, 2")
    q["iso3"] = _with(DASH) + "SELECT region, iso3, count(*) AS rows FROM dash GROUP BY 1, 2"

    # --- filters
    q["filter_in"] = _with(CLEAN) + (
        f"SELECT {cc} FROM clean WHERE region IN {_in(P.REGIONS)} AND category IN {_in(P.CATEGORIES)} "
        f"AND modality IN {_in(P.MODALITIES)}")
    q["export_filtered"] = q["filter_in"]
    q["filter_dates"] = _with(CLEAN) + (
        f"SELECT {cc} FROM clean WHERE posted_at >= {_ts(P.START)} AND posted_at <= {_ts(P.END)}")
    q["filter_dates_dashboard"] = _with(CLEAN) + (
        f"SELECT {cc} FROM clean WHERE posted_at >= {_ts(P.START)} "
        f"AND posted_at <= {_ts(P.END)} + INTERVAL 1 DAY")
    m = P.SCHEDULED_MINIMUMS
    q["engagement_filter"] = _with(KW) + (
        "SELECT * FROM kw WHERE "
        f"{_stat('diggCount')} >= {m['min_likes']} AND {_stat('commentCount')} >= {m['min_comments']} "
        f"AND {_stat('shareCount')} >= {m['min_shares']} AND {_stat('playCount')} >= {m['min_views']}")

    # --- API / dashboard reports (whole table, no row cut)
    q["api_keywords"] = _with(CLEAN) + (
        f"SELECT keyword, {_sum('engagement_total', 'total_engagement')}, {_sum('playCount', 'plays')}, "
        "count(DISTINCT video_id) AS count_videos FROM clean GROUP BY keyword "
        f"ORDER BY total_engagement DESC, keyword ASC LIMIT {P.API_TOP_N}")
    q["keyword_modality"] = _with(CLEAN) + (
        f"SELECT keyword, modality, {_sum('engagement_total', 'total_engagement')}, "
        f"{_sum('playCount', 'plays')} FROM clean "
        "WHERE keyword IS NOT NULL AND modality IS NOT NULL GROUP BY keyword, modality")
    km = (f"km AS (SELECT keyword, modality, {_sum('engagement_total', 'total_engagement')} FROM clean "
          "WHERE keyword IS NOT NULL AND modality IS NOT NULL GROUP BY keyword, modality)")
    dom = ("dom AS (SELECT keyword, modality FROM (SELECT *, row_number() OVER (PARTITION BY keyword "
           "ORDER BY total_engagement DESC, modality ASC) AS rn FROM km) WHERE rn = 1)")
    q["dominant_modality"] = _with(CLEAN, km, dom) + "SELECT keyword, modality FROM dom"
    topkw = (f"topkw AS (SELECT k.keyword, CAST(sum(k.total_engagement) AS BIGINT) AS total_engagement "
             f"FROM km k GROUP BY k.keyword ORDER BY total_engagement DESC, keyword ASC LIMIT {P.DASH_TOP_N})")
    q["top_keywords_modality"] = _with(CLEAN, km, dom, topkw) + (
        "SELECT t.keyword, t.total_engagement, d.modality FROM topkw t LEFT JOIN dom d ON t.keyword = d.keyword")
    q["region_map"] = _with(DASH) + (
        "SELECT region, iso3, round(avg(engagement_rate), 6) AS avg_engagement_rate, "
        f"{_sum('playCount', 'sum_plays')}, count(DISTINCT video_id) AS count_videos FROM dash "
        "WHERE region IS NOT NULL AND iso3 IS NOT NULL GROUP BY region, iso3")
    firstcat = ("fc AS (SELECT keyword, category FROM (SELECT keyword, category, row_number() OVER "
                "(PARTITION BY keyword ORDER BY engagement_total DESC, category ASC) AS rn FROM clean "
                "WHERE category IS NOT NULL) WHERE rn = 1)")
    q["scatter"] = _with(CLEAN, km, topkw, firstcat) + (
        "SELECT c.keyword, round(avg(virality_index), 6) AS avg_virality, "
        "round(avg(discussion_rate), 6) AS avg_discussion, "
        f"{_sum('engagement_total', 'total_engagement')}, {_sum('playCount', 'plays')}, "
        "any_value(fc.category) AS category FROM clean c LEFT JOIN fc ON c.keyword = fc.keyword "
        "WHERE c.keyword IN (SELECT keyword FROM topkw) GROUP BY c.keyword")
    q["category_compare"] = _with(CLEAN) + (
        f"SELECT category, {_sum('engagement_total', 'total_engagement')}, "
        "round(avg(engagement_rate), 6) AS avg_engagement_rate, count(DISTINCT video_id) AS count_videos "
        "FROM clean WHERE category IS NOT NULL GROUP BY category")
    q["filter_options"] = _with(DASH) + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS field, {c} AS value FROM dash WHERE {c} IS NOT NULL"
        for c in ("region", "category", "modality"))
    q["date_bounds"] = _with(CLEAN) + ("SELECT CAST(min(posted_at) AS DATE) AS min_date, "
                                       "CAST(max(posted_at) AS DATE) AS max_date FROM clean")
    dash_window = ("win AS (SELECT * FROM dash WHERE posted_at >= (SELECT CAST(CAST(min(posted_at) AS DATE) "
                   "AS TIMESTAMP) FROM dash) AND posted_at <= (SELECT CAST(CAST(max(posted_at) AS DATE) AS "
                   "TIMESTAMP) FROM dash) + INTERVAL 1 DAY)")
    q["row_count"] = _with(DASH, dash_window) + "SELECT count(*) AS rows FROM win"
    order_all = ", ".join(f"{c} ASC NULLS FIRST" for c in DASH_COLUMNS if c != "engagement_total")
    toprows = (f"tr AS (SELECT * FROM win ORDER BY engagement_total DESC, {order_all} "
               f"LIMIT {P.DASH_TOP_N})")
    q["top_rows"] = _with(DASH, dash_window, toprows) + "SELECT * FROM tr"
    q["dashboard_keywords"] = _with(DASH, dash_window, toprows) + (
        ", km2 AS (SELECT keyword, modality, CAST(sum(engagement_total) AS BIGINT) AS te FROM tr "
        "GROUP BY keyword, modality), "
        "d2 AS (SELECT keyword, modality FROM (SELECT *, row_number() OVER (PARTITION BY keyword "
        "ORDER BY te DESC, modality ASC) rn FROM km2) WHERE rn = 1) "
        "SELECT t.keyword, t.total_engagement, d2.modality FROM (SELECT keyword, "
        "CAST(sum(te) AS BIGINT) AS total_engagement FROM km2 GROUP BY keyword "
        f"ORDER BY total_engagement DESC, keyword ASC LIMIT {P.DASH_TOP_N}) t "
        "LEFT JOIN d2 ON t.keyword = d2.keyword")
    q["region_category_counts"] = _with(KW) + ("SELECT region, category, count(*) AS rows FROM kw "
                                               "GROUP BY region, category")
    grid = [f"SELECT unnest([{', '.join(map(_q, xs))}]) AS {c}" for c, xs in (("region", P.GRID_REGIONS), ("category", P.GRID_CATEGORIES))]
    q["coverage_grid"] = _with(KW) + (
        f"SELECT r.region, c.category, count(kw.video_id) AS rows FROM ({grid[0]}) r CROSS JOIN ({grid[1]}) c "
        "LEFT JOIN kw ON kw.region = r.region AND kw.category = c.category GROUP BY ALL")

    # --- workbook
    top10 = (f"t10 AS (SELECT keyword FROM clean GROUP BY keyword ORDER BY sum(engagement_total) DESC, "
             f"keyword ASC LIMIT {P.WB_TOP_N})")
    rng = []
    if P.WB_MIN_TOTAL is not None:
        rng.append(f"sum_engagement_total >= {P.WB_MIN_TOTAL}")
    if P.WB_MAX_TOTAL is not None:
        rng.append(f"sum_engagement_total <= {P.WB_MAX_TOTAL}")
    sheet1 = _with(CLEAN, top10) + (
        "SELECT * FROM (SELECT keyword, modality, "
        f"{_sum('engagement_total', 'sum_engagement_total')}, {_sum('playCount', 'sum_playcount')}, "
        "round(avg(playCount), 6) AS avg_playcount FROM clean WHERE keyword IN (SELECT keyword FROM t10) "
        "GROUP BY keyword, modality) s")
    q["wb_top_keywords"] = sheet1 + (" WHERE " + " AND ".join(rng) if rng else "")
    q["wb_top_keywords_all"] = sheet1  # the range filter at its full extent
    q["wb_region"] = _with(CLEAN) + (
        "SELECT region, round(avg(engagement_rate), 6) AS avg_engagement_rate, "
        f"{_sum('playCount', 'sum_playcount')}, CASE WHEN region IN {_in(P.WB_REGION_SET)} "
        f"THEN {_q(dims.WORKBOOK_REGION_LABEL)} ELSE '' END AS caption FROM clean "
        f"WHERE category IN {_in(P.WB_CATEGORIES)} AND modality IN {_in(P.WB_MODALITIES)} GROUP BY region")
    top30 = (f"t30 AS (SELECT keyword FROM clean GROUP BY keyword ORDER BY avg(playCount) DESC NULLS LAST, "
             f"keyword ASC LIMIT {P.WB_SCATTER_TOP_N})")
    q["wb_scatter"] = _with(CLEAN, top30) + (
        "SELECT keyword, region, round(avg(discussion_rate), 6) AS avg_discussion_rate, "
        "round(avg(virality_index), 6) AS avg_virality_index, "
        f"{_sum('engagement_total', 'sum_engagement_total')} FROM clean "
        "WHERE keyword IN (SELECT keyword FROM t30) "
        f"AND (region IS NULL OR region NOT IN {_in(P.WB_EXCLUDED_REGIONS)}) "
        "GROUP BY keyword, region")
    q["wb_category"] = _with(CLEAN) + (
        f"SELECT category, {_sum('engagement_total', 'sum_engagement_total')}, "
        "round(avg(engagement_rate), 6) AS avg_engagement_rate FROM clean GROUP BY category")

    # --- growth, backtest, metrics, rollup
    for name, args in P.GROWTH.items():
        q[name] = growth_sql(**args)
    for name, args in P.CATCH_UP.items():
        q[name] = catch_up_sql(**args)
    q["growth_rows"] = growth_rows_sql(**P.GROWTH_ROWS)
    q["backtest"] = backtest_sql(P.BACKTEST_DAYS_BACK, P.BACKTEST_HORIZON)
    q["metrics"] = metrics_sql()
    q["hourly_counts"] = _with(KW) + HOURLY_BODY.format(where="")
    q["hourly_counts_stream"] = q["hourly_counts"]
    q["backtest_delta"], q["metrics_bitmaps"], q["rollup_folded"] = q["backtest"], q["metrics"], q["hourly_counts"]
    q["growth_stored"], q["backtest_stored"], q["metrics_stored"] = q["growth_weekly"], q["backtest"], q["metrics"]
    q["sample_size"] = _with(DASH, dash_window) + (
        f"SELECT least({P.SAMPLE_N}, count(*)) AS sampled, CAST(0 AS BIGINT) AS foreign_rows FROM win")

    # --- video metadata path
    q["video_flatten"] = _with(VIDEOS) + (
        "SELECT id, video_play_addr AS url, desc_ AS caption, author_unique_id AS username, region, "
        "category, music_title, music_authorName AS music_author, COALESCE(stats_raw, '{}') AS stats_json "
        "FROM vp")
    q["video_fields"] = _with(VIDEOS, RECORDS) + "SELECT entry_id, video_id, region, category, stats FROM rec"
    q["posted_at"] = _with(VIDEOS, RECORDS) + "SELECT entry_id, detected_at, posted_at FROM rec"
    q["text_sources"] = _with(VIDEOS, SOURCES) + "SELECT entry_id, modality, frame, text FROM src"
    q["extract_keywords"] = _with(VIDEOS, RECORDS, SOURCES,
                                  *keyword_ctes("src", ["entry_id", "modality", "frame_k"])) + (
        "SELECT r.video_id, t.keyword, t.modality, CAST(1.0 AS DOUBLE) AS confidence, r.detected_at, "
        "r.posted_at, r.region, r.category, r.stats FROM top t JOIN rec r ON t.entry_id = r.entry_id")
    both = "SELECT * FROM src UNION ALL SELECT entry_id, modality, frame, frame_k, text FROM texts JOIN first_entry USING (video_id)"
    q["extract_with_texts"] = _with(
        VIDEOS, RECORDS, SOURCES, texts_cte(("conversations", "benchmark")),
        "first_entry AS (SELECT video_id, min(entry_id) AS entry_id FROM rec GROUP BY video_id)", f"every AS ({both})",
        *keyword_ctes("every", ["entry_id", "modality", "frame_k"])) + (
        "SELECT r.video_id, t.keyword, t.modality, CAST(1.0 AS DOUBLE) AS confidence, r.detected_at, "
        "r.posted_at, r.region, r.category, r.stats FROM top t JOIN rec r ON t.entry_id = r.entry_id")
    q["metadata_append"] = f"WITH flat AS ({q['video_flatten']}) SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE region = 'DE'"
    q["first_entries"] = _with(VIDEOS) + f"SELECT entry_id, id, region FROM vp ORDER BY entry_id LIMIT {P.DEMO_LIMIT}"
    q["csv_offsets"] = q["kw_facts"]
    q["insert_defaults"] = _with(KW) + f"SELECT * REPLACE (COALESCE(posted_at, {_ts(P.AS_OF)}) AS posted_at) FROM kw"
    q["metrics_table"] = f"SELECT * FROM ({metrics_sql()}) UNION ALL SELECT * FROM ({metrics_sql(P.EARLIER)})"
    q["extract_retry"], q["video_array"] = q["extract_keywords"], q["video_flatten"]
    least = " AND ".join(f"{_stat(f)} >= {n}" for f, n in (("diggCount", 50), ("commentCount", 5),
                                                           ("shareCount", 2), ("playCount", 1000)))
    q["run_all_trending"] = (  # every row is new: two mentions or more grow from nothing, by 999
        "SELECT keyword, region, category, CAST(count(*) AS INTEGER) AS mentions, CAST(999.0 AS DOUBLE) AS growth_rate "
        f"FROM ({q['extract_keywords']}) WHERE {least} GROUP BY ALL HAVING count(*) >= 2 "
        "ORDER BY keyword NULLS FIRST, region NULLS FIRST, category NULLS FIRST LIMIT 20")
    q["quarantine"] = _with(VIDEOS) + (
        ", lines AS (SELECT entry_id, COALESCE(NULLIF(id, ''), NULLIF(video_inner_id, ''), 'unknown') AS vid, "
        "to_json({'entry_id': entry_id, 'id': id, 'desc': desc_, 'region': region}) :: VARCHAR AS line "
        "FROM vp), cut AS (SELECT entry_id, vid, CASE WHEN entry_id % 17 = 0 "
        "THEN left(line, length(line) // 2) ELSE line END AS line FROM lines) "
        "SELECT entry_id, CASE WHEN json_valid(line) THEN 'ok' ELSE 'quarantined' END AS status, "
        "CASE WHEN json_valid(line) THEN vid END AS video_id FROM cut")

    # --- text path on documents / conversations / benchmark
    doc_keys = ["video_id", "modality", "frame_k"]
    kc = keyword_ctes("texts", doc_keys)
    q["token_freq"] = _with(texts_cte(("documents",)), *kc[:3]) + (
        "SELECT video_id, token, freq, first_pos FROM freq")
    q["detect_language"] = _with(texts_cte(("documents",)), *kc[:5]) + (
        "SELECT t.video_id, COALESCE(l.lang, 'en') AS lang FROM texts t LEFT JOIN lang l "
        "ON t.video_id = l.video_id AND t.modality = l.modality AND t.frame_k = l.frame_k")
    q["language_confusion"] = _with(texts_cte(("documents",)), *kc[:5]) + (
        ", truth AS (SELECT CAST(doc_id AS VARCHAR) AS video_id, lang AS lang_true FROM documents) "
        "SELECT tr.lang_true, COALESCE(l.lang, 'en') AS lang_detected, count(*) AS docs "
        "FROM texts t JOIN truth tr ON t.video_id = tr.video_id LEFT JOIN lang l "
        "ON t.video_id = l.video_id AND t.modality = l.modality AND t.frame_k = l.frame_k GROUP BY 1, 2")
    q["modality_union"] = _with(texts_cte(), *kc) + (
        "SELECT video_id, modality, CASE WHEN frame_k = -1 THEN NULL ELSE frame_k END AS frame, "
        "keyword, rank FROM top")
    q["keywords_corpus_stopwords"] = _with(texts_cte(), *keyword_ctes("texts", doc_keys, stopwords=(
        f"SELECT lang, word FROM (SELECT lang, unnest(list_distinct(regexp_extract_all(lower(text), {_q(TOKEN_PATTERN)}))) AS word "
        "FROM documents WHERE lang IS NOT NULL) JOIN (SELECT lang, count(*) AS texts FROM documents WHERE text IS NOT NULL GROUP BY lang) "
        f"USING (lang) GROUP BY lang, word, texts HAVING count(*) >= {P.STOPWORD_SHARE}::DOUBLE * texts"))) + (
        "SELECT video_id, modality, CASE WHEN frame_k = -1 THEN NULL ELSE frame_k END AS frame, keyword, rank FROM top")
    q["language_model"] = """
WITH docs AS (SELECT row_number() OVER () AS rn, doc_id, text, lang, md5(doc_id::VARCHAR)[1] < '5' AS held_out FROM documents),
words AS (SELECT rn, unnest(regexp_extract_all(lower(text), '\\p{L}{1,32}')) AS word FROM docs),
grams AS (SELECT rn, substr(' ' || word || ' ', unnest(range(1, length(word) + 1)), 3) AS gram FROM words),
counts AS (SELECT lang, gram, count(*) AS n FROM grams JOIN docs USING (rn) WHERE lang IS NOT NULL AND NOT held_out GROUP BY ALL),
totals AS (SELECT lang, sum(n) + 3000 AS total FROM counts GROUP BY lang),
best AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= 3000),
wanted AS (SELECT rn, gram, count(*) AS k FROM grams GROUP BY ALL),
scores AS (
  SELECT rn, t.lang, sum(k * floor(1000 * ln((coalesce(b.n, 0) + 1)::DOUBLE / t.total::DOUBLE))::BIGINT) AS s
  FROM wanted CROSS JOIN totals t LEFT JOIN best b ON b.lang = t.lang AND b.gram = wanted.gram GROUP BY ALL),
found AS (SELECT rn, lang FROM scores QUALIFY row_number() OVER (PARTITION BY rn ORDER BY s DESC, lang) = 1)
SELECT d.lang AS lang_true, held_out, coalesce(f.lang, 'en') AS lang_detected, count(*) AS docs
FROM docs d LEFT JOIN found f USING (rn) GROUP BY ALL"""
    return q
