"""File sources and sinks (S1-S14): JSON metadata, keyword CSV, parquet tables.

Every reader has an explicit schema; every writer is a distributed write (no
driver-side rows). Appends are idempotent per job only when the caller writes
to a fresh path or a partition it owns (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwpulse.schemas import CSV_TS_FORMAT, KW, KW_CLEAN_CSV, KW_CSV, VIDEO
from kwpulse.session import checkpoint_dir, scratch_path
from kwpulse.sources.runs import ATTEMPT, only_committed

CORRUPT = "_corrupt_record"
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"',
               "timestampNTZFormat": CSV_TS_FORMAT, "nullValue": "", "emptyValue": '""',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# ---- video metadata

def read_videos(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON lines, or with ``multiline`` file(s) holding one JSON array of records each.

    Every record is parsed by itself, so a malformed or mistyped one costs only itself: it is
    kept with its own text in ``_corrupt_record``; split those off with ``split_quarantine``.
    Files of both kinds are read by many tasks (arrays: ``sources.json_arrays``, at the price of two passes); a truncated
    array loses its last record only.
    """
    if multiline:
        from kwpulse.sources.json_arrays import array_records
        lines = array_records(spark, path)
    else:
        lines = spark.read.text(path)
    return parse_video_lines(lines.filter(F.trim("value") != ""), "value")


def parse_video_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """JSON text column -> VIDEO struct columns + ``_corrupt_record`` (PERMISSIVE)."""
    schema = T.StructType(VIDEO.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(column), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keep = [c for c in lines.columns if c != column]
    return lines.select(*keep, parsed.alias("_v")).select(*keep, "_v.*")


def split_quarantine(videos: DataFrame, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantined records); one bad record never stops the rest.

    Spark refuses queries on a raw JSON scan that need only the corrupt-record
    column, so the parsed records are first materialised once with a reliable
    ``checkpoint()`` into the shared ``spark.checkpoint.dir`` (which also cuts
    the lineage: later failures recompute from there, not from the raw files).
    Pass ``materialize=False`` for frames that are not raw file scans.
    """
    if CORRUPT not in videos.columns:
        return videos, videos.limit(0)
    if materialize:
        checkpoint_dir(videos.sparkSession)
        videos = videos.checkpoint(eager=True)
    bad = F.col(CORRUPT).isNotNull()
    return videos.filter(~bad).drop(CORRUPT), videos.filter(bad)


def append_videos(videos: DataFrame, path: str) -> None:
    """Append new records next to the old ones (duplicates kept)."""
    videos.write.mode("append").json(path)


# ---- keyword CSV

def write_keywords_csv(kw: DataFrame, path: str, mode: str = "append", attempt: str | None = None) -> None:
    """CSV with header; the stats column is spelled ``stats_json``. With ``attempt`` the rows go
    to that attempt's partition."""
    out = kw.withColumnRenamed("stats", "stats_json") if "stats" in kw.columns else kw
    if attempt:
        out = out.withColumn(ATTEMPT, F.lit(attempt))
    out.write.mode(mode).options(**CSV_OPTIONS).partitionBy(*[ATTEMPT] * bool(attempt)).csv(path)


def read_keywords_csv(spark: SparkSession, path: str, clean: bool = False, multiline: bool = False,
                      ledger: str | None = None) -> DataFrame:
    """Typed CSV read (never inferred); a missing path raises. With ``ledger`` the rows of
    committed runs only.

    Timestamps may have a fraction and an offset or not (``2025-11-09 12:34:56.123456+00:00``);
    they become UTC, unparsable ones NULL. ``multiline`` allows line breaks inside quoted values,
    at the price of files that can't be split.
    """
    schema = KW_CLEAN_CSV if clean else KW_CSV
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    texts = T.StructType([T.StructField(f.name, T.StringType()) if f.name in times else f for f in schema.fields])
    rows = spark.read.schema(_with_attempt(texts, ledger)).options(**CSV_OPTIONS, multiLine=str(multiline).lower()).csv(path)
    rows = (only_committed(rows, ledger) if ledger else rows).select(*texts.names)
    return rows.withColumns({c: F.col(c).try_cast("timestamp").cast("timestamp_ntz") for c in times})


def csv_as_facts(df: DataFrame) -> DataFrame:
    """CSV spelling -> fact-table spelling."""
    return df.withColumnRenamed("stats_json", "stats")


# ---- parquet tables

def _with_attempt(schema: T.StructType, ledger: str | None) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(ATTEMPT, T.StringType())]) if ledger else schema


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several plans read to the shared folder, once, and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_facts(kw: DataFrame, path: str, mode: str = "append", attempt: str | None = None) -> None:
    """Keyword facts partitioned by detection date (time chunking), and with ``attempt`` below that by
    the attempt that wrote them (``sources.runs``).

    The ``rebalance`` hint clusters rows by date so each date gets few files, and
    lets AQE split a date that holds a large share of the rows over several
    writers (``optimizeSkewsInRebalancePartitions``) instead of one task.
    """
    if attempt:
        kw = kw.withColumn(ATTEMPT, F.lit(attempt))
    (kw.withColumn("detected_date", F.to_date("detected_at"))
       .hint("rebalance", "detected_date")
       .write.mode(mode).partitionBy("detected_date", *[ATTEMPT] * bool(attempt)).parquet(path))


def facts_schema(*text_partitions: str) -> T.StructType:
    return T.StructType(KW.fields + [T.StructField("detected_date", T.DateType())]
                        + [T.StructField(c, T.StringType()) for c in text_partitions])


def read_facts(spark: SparkSession, path: str, ledger: str | None = None) -> DataFrame:
    """The stored fact table; date predicates prune ``detected_date`` partitions. With ``ledger`` the
    rows of committed runs only."""
    schema = facts_schema()
    rows = spark.read.schema(_with_attempt(schema, ledger)).parquet(path)
    return (only_committed(rows, ledger) if ledger else rows).select(*schema.names)


def write_table(df: DataFrame, path: str, mode: str = "append", run_id: str | None = None) -> None:
    """Append to a parquet table (trending rows, metrics). With ``run_id`` the rows become that run's
    partition, so repeating the run replaces them."""
    if run_id is None:
        return df.write.mode(mode).parquet(path)
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id").parquet(path))


def with_defaults(df: DataFrame, as_of, columns=("detected_at",)) -> DataFrame:
    """Column defaults on insert (``now()`` -> the job's ``as_of``)."""
    from kwpulse.functions.exprs import ts_lit
    return df.withColumns({c: F.coalesce(F.col(c), ts_lit(as_of)) for c in columns if c in df.columns})
