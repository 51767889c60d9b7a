"""The BI workbook's four sheets.

Top-N sets are computed over all rows first (the workbook's Top N filters run
before its dimension filters) and ranked from the sheet's own aggregate, written once, so the
fact rows are scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.functions import dims
from kwpulse.functions.exprs import r6
from kwpulse.sources.files import stored


def _top_keywords(agg: DataFrame, measure, n: int) -> DataFrame:
    """The rows of ``agg`` (one per keyword x dimension value) of the N best keywords.

    The aggregate is written once; the N keywords are taken from its regroup and joined back to it (N rows, broadcast;
    a null keyword is one too), so the facts are scanned once and no keyword's rows are gathered."""
    agg = stored(agg, "sheet")
    best = (agg.groupBy("keyword").agg(measure.alias("_m"))
               .orderBy(F.desc_nulls_last("_m"), F.asc_nulls_first("keyword")).limit(n).select(F.col("keyword").alias("_k")))
    return agg.join(F.broadcast(best), F.col("keyword").eqNullSafe(F.col("_k")), "left_semi")


def keyword_modality(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("keyword", "modality")
                 .agg(F.sum("engagement_total").alias("sum_engagement_total"),
                      F.sum("playCount").alias("sum_playcount"),
                      r6(F.avg("playCount")).alias("avg_playcount")))


def keyword_region(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("keyword", "region")
                 .agg(r6(F.avg("discussion_rate")).alias("avg_discussion_rate"),
                      r6(F.avg("virality_index")).alias("avg_virality_index"),
                      F.sum("engagement_total").alias("sum_engagement_total"),
                      F.sum("playCount").alias("_play_sum"),
                      F.count("playCount").alias("_play_n")))


def top_keywords_sheet(clean: DataFrame, top_n: int = 10, min_total: int | None = None,
                       max_total: int | None = None) -> DataFrame:
    """Sheet 1: top N keywords by SUM(engagement_total), bars split by modality,
    range filter on the (keyword, modality) sum."""
    out = _top_keywords(keyword_modality(clean), F.sum("sum_engagement_total"), top_n)
    if min_total is not None:
        out = out.filter(F.col("sum_engagement_total") >= min_total)
    if max_total is not None:
        out = out.filter(F.col("sum_engagement_total") <= max_total)
    return out


def region_sheet(clean: DataFrame, categories: Sequence[str] = tuple(dims.COLLECTOR_CATEGORIES),
                 modalities: Sequence[str] = tuple(dims.WORKBOOK_MODALITIES),
                 region_set: Sequence[str] = tuple(dims.WORKBOOK_REGION_SET),
                 label: str = dims.WORKBOOK_REGION_LABEL) -> DataFrame:
    """Sheet 2: mean engagement rate and plays per region for the selected
    categories/modalities; regions in the set carry a caption."""
    rows = clean.filter(F.col("category").isin(list(categories))
                        & F.col("modality").isin(list(modalities)))
    return (rows.groupBy("region")
                .agg(r6(F.avg("engagement_rate")).alias("avg_engagement_rate"),
                     F.sum("playCount").alias("sum_playcount"))
                .withColumn("caption", F.when(F.col("region").isin(list(region_set)), F.lit(label))
                            .otherwise(F.lit(""))))


def scatter_sheet(clean: DataFrame, top_n: int = 30,
                  excluded_regions: Sequence[str] = tuple(dims.WORKBOOK_EXCLUDED_REGIONS)) -> DataFrame:
    """Sheet 3: top N keywords by AVG(playCount); per (keyword, region) mean
    discussion and virality and summed engagement; excluded regions dropped
    (NULL region is a member of the level and stays).

    The (keyword, region) aggregate carries the play sum and count, from which
    the per-keyword mean (the Top N measure, over all regions) is re-aggregated.
    """
    mean_play = F.try_divide(F.sum("_play_sum"), F.sum("_play_n"))
    rows = _top_keywords(keyword_region(clean), mean_play, top_n).drop("_play_sum", "_play_n")
    return rows.filter(F.col("region").isNull() | ~F.col("region").isin(list(excluded_regions)))


def category_sheet(clean: DataFrame) -> DataFrame:
    """Sheet 4: per category summed engagement and mean rate, largest first."""
    return (clean.groupBy("category")
                 .agg(F.sum("engagement_total").alias("sum_engagement_total"),
                      r6(F.avg("engagement_rate")).alias("avg_engagement_rate"))
                 .orderBy(F.desc("sum_engagement_total"), F.asc_nulls_first("category")))
