"""Clean job (C2): stats JSON -> five counts -> five KPIs; dashboard load step.

All narrow (per-row) expressions: no shuffle, one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.functions import dims
from kwpulse.functions.exprs import norm_region, safe_rate
from kwpulse.schemas import KPI_FIELDS, STAT_FIELDS


def stats_column(df: DataFrame) -> str:
    return "stats" if "stats" in df.columns else "stats_json"


RAW = {f: f"_raw_{f}" for f in STAT_FIELDS}


def with_stat_texts(df: DataFrame, stats: str | None = None) -> DataFrame:
    """Add ``_raw_<count>`` text columns from the JSON stats, parsed ONCE per row.

    ``json_tuple`` is a generator that always yields exactly one row (NULLs for
    NULL, invalid or non-object JSON), so no row is lost; being a generator it
    also keeps later predicates on these columns from being re-inlined as one
    parse per reference.
    """
    s = F.col(stats or stats_column(df))
    return df.select("*", F.json_tuple(s, *STAT_FIELDS).alias(*RAW.values()))


def raw_count(field: str):
    """Count as the database reads ``(stats->>'x')::int``: missing/invalid -> NULL."""
    return F.col(RAW[field]).try_cast("bigint")


def count_value(field: str):
    """Count for the clean table: text and fractional spellings (``"12"``, ``12.0``) count too."""
    return F.coalesce(raw_count(field), F.col(RAW[field]).try_cast("double").try_cast("bigint"))


def expand_stats(kw: DataFrame) -> DataFrame:
    """Add the five counts; invalid/NULL/non-object JSON and missing keys give 0."""
    return (with_stat_texts(kw)
            .withColumns({f: F.coalesce(count_value(f), F.lit(0).cast("bigint")) for f in STAT_FIELDS})
            .drop(*RAW.values()))


def add_kpis(df: DataFrame) -> DataFrame:
    """P11-P15."""
    play = F.col("playCount")
    total = F.col("diggCount") + F.col("commentCount") + F.col("shareCount") + F.col("collectCount")
    return (df.withColumn("engagement_total", total)
              .withColumns({
                  "engagement_rate": safe_rate(F.col("engagement_total"), play),
                  "virality_index": safe_rate(F.col("shareCount"), play),
                  "discussion_rate": safe_rate(F.col("commentCount"), play),
                  "save_rate": safe_rate(F.col("collectCount"), play),
              }))


def clean(kw: DataFrame) -> DataFrame:
    """Keyword facts -> clean table (facts + 5 counts + 5 KPIs)."""
    return add_kpis(expand_stats(kw))


def dashboard_frame(clean_df: DataFrame, iso: DataFrame | None = None, with_iso: bool = True) -> DataFrame:
    """Dashboard load (P16-P18, P22/J5): backfill missing numeric columns with 0,
    normalise region, look up iso3 (unknown code -> NULL).

    ``with_iso`` off leaves the code out. ``iso`` is a fixed-size dimension (``dims.iso_df``) joined by broadcast.
    """
    df = clean_df
    missing = {c: F.lit(0) for c in STAT_FIELDS + KPI_FIELDS if c not in df.columns}
    if missing:
        df = df.withColumns(missing)
    df = df.withColumn("region", norm_region(F.col("region")) if "region" in df.columns
                       else F.lit("UNKNOWN"))
    if not with_iso:
        return df
    if iso is None:
        iso = dims.iso_df(df.sparkSession)
    return (df.join(iso, df.region == iso.alpha2, "left")
              .drop("alpha2").withColumnRenamed("alpha3", "iso3"))
