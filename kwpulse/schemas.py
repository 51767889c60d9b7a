"""Explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

STAT_FIELDS = ["collectCount", "commentCount", "diggCount", "playCount", "shareCount"]
KPI_FIELDS = ["engagement_total", "engagement_rate", "virality_index", "discussion_rate", "save_rate"]

# Raw video payload as a collector writes it (every field nullable). ``stats`` keeps the
# object's JSON text: all its keys, however their values are spelled.
MUSIC = T.StructType([T.StructField("title", S), T.StructField("author", S),
                      T.StructField("authorName", S)])
VIDEO_INNER = T.StructType([T.StructField("id", S), T.StructField("playAddr", S),
                            T.StructField("createTime", S)])
AUTHOR = T.StructType([T.StructField("uniqueId", S)])

VIDEO = T.StructType([
    T.StructField("id", S), T.StructField("url", S), T.StructField("caption", S),
    T.StructField("desc", S), T.StructField("username", S), T.StructField("region", S),
    T.StructField("category", S), T.StructField("createTime", S), T.StructField("playAddr", S),
    T.StructField("music", MUSIC), T.StructField("stats", S),
    T.StructField("video", VIDEO_INNER), T.StructField("author", AUTHOR),
])

# Texts of any modality, one row per (video, modality, frame).
MODAL_TEXTS = T.StructType([
    T.StructField("video_id", S, False), T.StructField("modality", S, False),
    T.StructField("frame", L), T.StructField("text", S),
])

# Keyword facts: the stored table / CSV of the extraction step.
KW_COLUMNS = ["video_id", "keyword", "modality", "confidence", "detected_at",
              "posted_at", "region", "category", "stats"]
KW = T.StructType([
    T.StructField("video_id", S, False), T.StructField("keyword", S, False),
    T.StructField("modality", S, False), T.StructField("confidence", D),
    T.StructField("detected_at", TS, False), T.StructField("posted_at", TS),
    T.StructField("region", S), T.StructField("category", S), T.StructField("stats", S),
])

# The keyword CSV spells the stats column ``stats_json``.
KW_CSV = T.StructType([f if f.name != "stats" else T.StructField("stats_json", S)
                       for f in KW.fields])

# Clean table = keyword CSV + five counts + five KPIs.
KW_CLEAN_CSV = T.StructType(
    list(KW_CSV.fields)
    + [T.StructField(f, L) for f in STAT_FIELDS]
    + [T.StructField("engagement_total", L)]
    + [T.StructField(f, D) for f in KPI_FIELDS[1:]])

HOURLY = T.StructType([
    T.StructField("bucket", TS), T.StructField("keyword", S), T.StructField("region", S),
    T.StructField("category", S), T.StructField("mentions", L),
])

# The spelling written; any spelling that casts to a timestamp is read.
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
