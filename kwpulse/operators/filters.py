"""Row filters of the API, dashboard and growth job.

Plain column predicates: Catalyst pushes them below joins and, where they
touch source columns, into the parquet scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kwpulse.functions.exprs import ts_lit
from kwpulse.operators.clean import RAW, raw_count, with_stat_texts


def filter_in(df: DataFrame, regions: Sequence[str] | None = None,
              categories: Sequence[str] | None = None,
              modalities: Sequence[str] | None = None) -> DataFrame:
    """optional IN lists; an empty or missing list means no filter."""
    for col, values in (("region", regions), ("category", categories), ("modality", modalities)):
        if values:
            df = df.filter(F.col(col).isin(list(values)))
    return df


def _ts(v) -> Column:
    return ts_lit(v if not isinstance(v, _dt.date) or isinstance(v, _dt.datetime)
                  else _dt.datetime(v.year, v.month, v.day))


def filter_dates(df: DataFrame, start=None, end=None, end_plus_one_day: bool = False,
                 column: str = "posted_at") -> DataFrame:
    """F2 (API: inclusive bounds) and F3 (dashboard: end + 1 day, inclusive).

    A NULL timestamp never passes a bound that is given.
    """
    c = F.col(column)
    if start is not None:
        df = df.filter(c >= _ts(start))
    if end is not None:
        hi = _ts(end)
        if end_plus_one_day:
            hi = hi + F.expr("INTERVAL 1 DAY")
        df = df.filter(c <= hi)
    return df


def engagement_predicate(min_likes: int = 0, min_comments: int = 0, min_shares: int = 0,
                         min_views: int = 0) -> Column:
    """F5 over the ``_raw_*`` columns of ``clean.with_stat_texts``: all four JSON
    counts at least their minimum; a missing key or invalid JSON is NULL and
    fails even a zero minimum (as in SQL)."""
    return ((raw_count("diggCount") >= min_likes)
            & (raw_count("commentCount") >= min_comments)
            & (raw_count("shareCount") >= min_shares)
            & (raw_count("playCount") >= min_views))


def engagement_filter(kw: DataFrame, **minimums) -> DataFrame:
    """F5 on fact rows (stats parsed once per row)."""
    return (with_stat_texts(kw).filter(engagement_predicate(**minimums))
            .drop(*RAW.values()))


def export_filtered(clean: DataFrame, path: str, regions: Sequence[str] | None = None,
                    categories: Sequence[str] | None = None, modalities: Sequence[str] | None = None,
                    start=None, end=None, mode: str = "overwrite") -> None:
    """The API's filtered export — the F1/F2 filters, written as CSV with a
    header (a distributed write: each task writes its own part file)."""
    from kwpulse.sources.files import write_keywords_csv
    rows = filter_dates(filter_in(clean, regions, categories, modalities), start, end)
    write_keywords_csv(rows, path, mode=mode)


def filter_equal(df: DataFrame, region: str | None = None, category: str | None = None) -> DataFrame:
    """optional equality on region / category."""
    if region:
        df = df.filter(F.col("region") == region)
    if category:
        df = df.filter(F.col("category") == category)
    return df
