"""Video metadata records -> fields, text sources and keyword facts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kwpulse.functions.exprs import blank_to_null, epoch_seconds_to_ts, first_truthy, ts_lit
from kwpulse.operators.extract import keyword_lists, with_frame_key
from kwpulse.schemas import KW_COLUMNS


def _stats_json(raw: DataFrame) -> Column:
    """The stats as JSON text, with all their keys; missing stats give '{}' (never NULL)."""
    text = F.col("stats") if isinstance(raw.schema["stats"].dataType, StringType) else F.to_json("stats")
    return F.coalesce(text, F.lit("{}"))


def flatten_payload(raw: DataFrame) -> DataFrame:
    """Collector payload -> flat record (scalar columns)."""
    return raw.select(
        F.col("id"), F.col("video.playAddr").alias("url"), F.col("desc").alias("caption"),
        F.col("author.uniqueId").alias("username"), F.col("region"), F.col("category"),
        F.col("music.title").alias("music_title"),
        F.col("music.authorName").alias("music_author"),
        _stats_json(raw).alias("stats_json"))


def video_id(raw: DataFrame) -> Column:
    return first_truthy(F.col("id"), F.col("video.id"), F.lit("unknown"))


def posted_at(raw: DataFrame, detected_at: Column) -> Column:
    """P5: first truthy createTime (numeric 0 is falsy), epoch seconds; missing or
    unparsable -> detected_at (a bad value does not fall through)."""
    def truthy(c: Column) -> Column:
        c = blank_to_null(c)
        return F.when(c == "0", F.lit(None)).otherwise(c)
    secs = F.coalesce(truthy(F.col("createTime")), truthy(F.col("video.createTime"))).try_cast("bigint")
    return F.coalesce(epoch_seconds_to_ts(secs), detected_at)


def video_records(raw: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """One row per entry with the metadata every keyword row repeats."""
    detected = ts_lit(as_of)
    return raw.select(
        "entry_id", video_id(raw).alias("video_id"),
        first_truthy(F.col("region"), F.lit("unknown")).alias("region"),
        blank_to_null(F.col("category")).alias("category"),
        _stats_json(raw).alias("stats"),
        detected.alias("detected_at"),
        posted_at(raw, detected).alias("posted_at"))


def music_text(raw: DataFrame) -> Column:
    """Title and author joined by a space; ``authorName`` or the collector's ``author``."""
    author = first_truthy(F.col("music.authorName"), F.col("music.author"))
    return F.concat_ws(" ", blank_to_null(F.col("music.title")), author)


def text_sources(raw: DataFrame) -> DataFrame:
    """(entry_id, modality, frame, text), one row per non-empty text."""
    cap = first_truthy(F.col("desc"), F.col("caption"))
    mus = music_text(raw)
    mus = F.when(F.trim(mus) != "", mus)
    arr = F.array(F.struct(F.lit("caption").alias("modality"), cap.alias("text")),
                  F.struct(F.lit("music").alias("modality"), mus.alias("text")))
    return (raw.select("entry_id", F.explode(F.filter(arr, lambda s: s["text"].isNotNull())).alias("s"))
               .select("entry_id", F.col("s.modality").alias("modality"),
                       F.lit(None).cast("bigint").alias("frame"), F.col("s.text").alias("text")))


def ensure_entry_id(raw: DataFrame) -> DataFrame:
    """Entries need a key of their own: ``id`` repeats across categories and may be empty."""
    if "entry_id" in raw.columns:
        return raw
    return raw.withColumn("entry_id", F.monotonically_increasing_id())


def first_entries(raw: DataFrame, n: int) -> DataFrame:
    """The first n entries in input order (a per-task top-n, then one merge)."""
    return raw.orderBy("entry_id").limit(n)


def entry_texts(raw: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of other modalities, keyed by ``video_id`` (schema ``MODAL_TEXTS``), as texts of
    entries. Where several entries carry one id, its texts go to the first (so their keywords are
    not repeated); texts of unknown ids are left out."""
    first = raw.groupBy(video_id(raw).alias("video_id")).agg(F.min("entry_id").alias("entry_id"))
    return texts.join(first, "video_id").select("entry_id", "modality", "frame", "text")


def extract_keyword_facts(raw: DataFrame, as_of: _dt.datetime, top_k: int = 20,
                          extra_texts: DataFrame | None = None, stopwords: DataFrame | None = None) -> DataFrame:
    """Metadata (+ optional per-frame texts keyed by entry_id) -> keyword facts.

    Keywords are extracted per (entry, modality, frame) and joined back to the
    entry's metadata on ``entry_id`` (one sort-merge or AQE-broadcast join), as one row
    a text, so that the join moves and sorts no more rows than there are texts and entries.
    """
    raw = ensure_entry_id(raw)
    texts = text_sources(raw)
    if extra_texts is not None:
        texts = texts.unionByName(extra_texts.select("entry_id", "modality", "frame", "text"))
    keys = ["entry_id", "modality", "frame_k"]
    lists = keyword_lists(with_frame_key(texts), keys, top_k, stopwords)
    entries = video_records(raw, as_of)
    return (lists.join(entries, "entry_id", "inner")
               .withColumn("keyword", F.explode("keywords"))
               .withColumn("confidence", F.lit(1.0))
               .select(*KW_COLUMNS))
