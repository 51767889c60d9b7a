"""API and dashboard reports.

Every aggregate is a ``groupBy`` with partial (map-side) aggregation, so a hot
keyword costs one partial row per task before the shuffle. Exact distinct
counts are planned by Spark as a two-level aggregate keyed by (group, value),
which spreads a skewed group over many tasks. Top-N uses ``orderBy().limit()``
(TakeOrderedAndProject: per-task top-N, no global sort). Every order has a
total tie-break so results are repeatable across engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.functions import dims
from kwpulse.functions.exprs import r6


def api_keywords(df: DataFrame, top_n: int = 50) -> DataFrame:
    """Per keyword total engagement, plays, distinct videos; top N."""
    agg = (df.groupBy("keyword")
             .agg(F.sum("engagement_total").alias("total_engagement"),
                  F.sum("playCount").alias("plays"),
                  F.count_distinct("video_id").alias("count_videos")))
    return agg.orderBy(F.desc("total_engagement"), F.asc("keyword")).limit(top_n)


def top_rows(df: DataFrame, top_n: int | None = 20) -> DataFrame:
    """The N fact rows with the highest engagement (dashboard "Top N").

    Ties are broken by every remaining column so the kept set is unique.
    """
    if not top_n:
        return df
    order = [F.desc("engagement_total")] + [F.asc_nulls_first(c) for c in df.columns
                                            if c != "engagement_total"]
    return df.orderBy(*order).limit(top_n)


def keyword_modality(df: DataFrame) -> DataFrame:
    """Per (keyword, modality) total engagement and plays."""
    return (df.filter(F.col("keyword").isNotNull() & F.col("modality").isNotNull())
              .groupBy("keyword", "modality")
              .agg(F.sum("engagement_total").alias("total_engagement"),
                   F.sum("playCount").alias("plays")))


def keyword_modality_sheet(df: DataFrame) -> DataFrame:
    """A9 in the dashboard's order, largest first."""
    return keyword_modality(df).orderBy(F.desc("total_engagement"), "keyword", "modality")


def dominant_modality(kw_mod: DataFrame) -> DataFrame:
    """Per keyword the modality with the highest engagement (ties: modality A-Z).

    ``min_by`` over a (-engagement, modality) key is an aggregate, so it is
    partially aggregated like any sum — no per-keyword sort/window.
    """
    return kw_mod.groupBy("keyword").agg(_dominant("modality", "total_engagement").alias("modality"))


def _dominant(value: str, weight: str):
    """The value with the largest weight; ties go to the alphabetically first value."""
    return F.min_by(value, F.struct((-F.col(weight)).alias("neg"), F.col(value).alias("v")))


def top_keywords_modality(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Top keywords by engagement with their dominant modality."""
    km = keyword_modality(df)
    per_kw = (km.groupBy("keyword")
                .agg(F.sum("total_engagement").alias("total_engagement"),
                     _dominant("modality", "total_engagement").alias("modality")))
    return per_kw.orderBy(F.desc("total_engagement"), F.asc("keyword")).limit(top_n)


def region_map(rows: DataFrame) -> DataFrame:
    """Per (region, iso3) mean engagement rate, plays, distinct videos; no-iso rows dropped.

    The ISO code is a function of the region, so it is looked up once per region, after the aggregate; a code
    that the rows may carry already is not read."""
    per = (rows.filter(F.col("region").isNotNull()).groupBy("region")
               .agg(r6(F.avg("engagement_rate")).alias("avg_engagement_rate"),
                    F.sum("playCount").alias("sum_plays"),
                    F.count_distinct("video_id").alias("count_videos")))
    iso = dims.iso_df(rows.sparkSession)
    return per.join(iso, per.region == iso.alpha2).select(
        "region", F.col("alpha3").alias("iso3"), "avg_engagement_rate", "sum_plays", "count_videos")


def scatter(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Per keyword mean virality/discussion, sums, first category —
    kept for the top keywords of ``top_keywords_modality``.

    Two levels. First per (keyword, category), all buffers fixed-width (sums,
    counts, max), so it is a hash aggregate with map-side combine over the fact
    rows; picking a *string* per group (``min_by``) has a variable-width buffer,
    which Spark runs as a sort-based aggregate, so it is kept for the second level,
    over at most one row per keyword x category. "First" category follows the
    engagement-descending row order of the dashboard: the category of the
    highest-engagement row that has one (ties: category A-Z). The top list ranks
    keywords by the engagement of their rows that have a modality (the rows the
    keyword x modality table keeps), one more conditional sum; the top N is taken
    from the per-keyword rows directly — no second scan, no join.
    """
    per_cat = (df.filter(F.col("keyword").isNotNull())
                 .groupBy("keyword", "category")
                 .agg(F.sum("virality_index").alias("_vir_sum"), F.count("virality_index").alias("_vir_n"),
                      F.sum("discussion_rate").alias("_disc_sum"), F.count("discussion_rate").alias("_disc_n"),
                      F.sum("engagement_total").alias("_eng"), F.sum("playCount").alias("_plays"),
                      F.sum(F.when(F.col("modality").isNotNull(), F.col("engagement_total"))).alias("_rank"),
                      F.max("engagement_total").alias("_best")))
    first_key = F.when(F.col("category").isNotNull(),
                       F.struct((-F.col("_best")).alias("neg"), F.col("category").alias("v")))
    agg = (per_cat.groupBy("keyword")
                  .agg(r6(F.try_divide(F.sum("_vir_sum"), F.sum("_vir_n"))).alias("avg_virality"),
                       r6(F.try_divide(F.sum("_disc_sum"), F.sum("_disc_n"))).alias("avg_discussion"),
                       F.sum("_eng").alias("total_engagement"),
                       F.sum("_plays").alias("plays"),
                       F.min_by("category", first_key).alias("category"),
                       F.sum("_rank").alias("_rank")))
    return (agg.filter(F.col("_rank").isNotNull())  # keywords without a modality row are not ranked
               .orderBy(F.desc("_rank"), F.asc("keyword")).limit(top_n).drop("_rank"))


def category_compare(df: DataFrame) -> DataFrame:
    """Per category total engagement, mean rate, distinct videos; largest first."""
    return (df.filter(F.col("category").isNotNull())
              .groupBy("category")
              .agg(F.sum("engagement_total").alias("total_engagement"),
                   r6(F.avg("engagement_rate")).alias("avg_engagement_rate"),
                   F.count_distinct("video_id").alias("count_videos"))
              .orderBy(F.desc("total_engagement"), "category"))


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct non-NULL values of region, category, modality as (field, value).

    One scan: each row emits its three (field, value) pairs, and one distinct
    (partial per task, then one shuffle of the few distinct pairs) serves all three.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                      for c in ("region", "category", "modality")])
    return (df.select(F.inline(pairs))
              .filter(F.col("value").isNotNull())
              .distinct().orderBy("field", "value"))


def date_bounds(df: DataFrame, column: str = "posted_at") -> DataFrame:
    """First and last posting date."""
    return df.agg(F.min(column).cast("date").alias("min_date"),
                  F.max(column).cast("date").alias("max_date"))


def row_count(df: DataFrame) -> DataFrame:
    """A20 as a one-row frame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def sample_rows(df: DataFrame, n: int = 200, seed: int = 42) -> DataFrame:
    """A pseudo-random sample of min(n, rows) rows, the same for the same seed and input split.

    Every row draws its own number, so equal rows are picked independently; ``limit`` keeps a
    per-task top-n, so only n rows per task reach the final merge.
    """
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def region_category_counts(df: DataFrame) -> DataFrame:
    """Coverage of the (region, category) grid that has data (J6 re-aimed)."""
    return df.groupBy("region", "category").agg(F.count(F.lit(1)).alias("rows"))


def coverage_grid(df: DataFrame, regions: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Every (region, category) cell of two given lists with its number of rows, 0 where there are none.

    The grid comes from two literal lists (their bound is the caller's); the facts are counted first, by
    map-side aggregation, and only the counts meet the grid."""
    cells = (df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(r) for r in dict.fromkeys(regions)])).alias("region"))
               .select("region", F.explode(F.array(*[F.lit(c) for c in dict.fromkeys(categories)])).alias("category")))
    counts = region_category_counts(df.where(F.col("region").isin(list(regions)) & F.col("category").isin(list(categories))))
    return cells.join(counts, ["region", "category"], "left").select(
        "region", "category", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
