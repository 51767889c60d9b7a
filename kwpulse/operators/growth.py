"""Trending detection (C3), backtest (C4) and pipeline metrics.

The reference scans the fact table once per window / cut-off / metric; here each
job is ONE scan with conditional aggregates (``count_if``), and the time bounds
are plain predicates on ``detected_at`` so they reach the parquet scan as
pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.functions.exprs import growth_case, ts_lit
from kwpulse.operators.clean import with_stat_texts
from kwpulse.operators.filters import engagement_predicate, filter_equal

# time_window name -> length of one period
WINDOWS = {"hourly": _dt.timedelta(hours=1), "daily": _dt.timedelta(days=1),
           "weekly": _dt.timedelta(days=7)}

GROUP = ["keyword", "region", "category"]


def detected_between(kw: DataFrame, lo: _dt.datetime | None = None,
                     hi: _dt.datetime | None = None, hi_inclusive: bool = False) -> DataFrame:
    """``lo <= detected_at < hi`` (``<= hi`` when inclusive), either bound optional.

    On the stored fact table (partitioned by ``detected_date = to_date(detected_at)``)
    the implied date bounds are added too, so whole date partitions are pruned
    before any file is listed or opened; the ``detected_at`` bounds are pushed to
    the parquet reader for the boundary dates.
    """
    ts = F.col("detected_at")
    if lo is not None:
        kw = kw.filter(ts >= ts_lit(lo))
    if hi is not None:
        kw = kw.filter(ts <= ts_lit(hi) if hi_inclusive else ts < ts_lit(hi))
    if "detected_date" in kw.columns:
        d = F.col("detected_date")
        if lo is not None:
            kw = kw.filter(d >= F.lit(lo.date()))
        if hi is not None:
            kw = kw.filter(d <= F.lit(hi.date()))
    return kw


def window_bounds(as_of: _dt.datetime, time_window: str):
    """Previous [as_of-2d, as_of-d), current [as_of-d, as_of)."""
    if time_window not in WINDOWS:
        raise ValueError(f"Invalid time_window={time_window}")
    d = WINDOWS[time_window]
    return as_of - 2 * d, as_of - d, as_of


def growth(kw: DataFrame, as_of: _dt.datetime, time_window: str = "hourly",
           growth_threshold: float = 0.5, region: str | None = None,
           category: str | None = None, min_likes: int = 0, min_comments: int = 0,
           min_shares: int = 0, min_views: int = 0, limit: int | None = 20) -> DataFrame:
    """Keywords whose mentions grew between two adjacent windows.

    Output: keyword, region, category, current_mentions, prev_mentions, growth_rate.
    Equivalent to current ⟕ previous on (keyword, region, category) with plain
    equality: a NULL key never finds its previous count, so it gets 0.
    """
    lo, mid, hi = window_bounds(as_of, time_window)
    ts = F.col("detected_at")
    base = with_stat_texts(detected_between(kw, lo, hi))
    base = base.filter(engagement_predicate(min_likes, min_comments, min_shares, min_views))
    base = filter_equal(base, region, category)
    agg = (base.groupBy(*GROUP)
               .agg(F.count_if(ts >= ts_lit(mid)).cast("double").alias("current_mentions"),
                    F.count_if(ts < ts_lit(mid)).cast("double").alias("_prev")))
    null_key = F.col("keyword").isNull() | F.col("region").isNull() | F.col("category").isNull()
    out = (agg.filter(F.col("current_mentions") > 0)
              .withColumn("prev_mentions", F.when(null_key, F.lit(0.0)).otherwise(F.col("_prev")))
              .withColumn("growth_rate", growth_case(F.col("current_mentions"), F.col("prev_mentions")))
              .filter(F.col("growth_rate") >= F.lit(float(growth_threshold)))
              .select(*GROUP, "current_mentions", "prev_mentions", "growth_rate"))
    order = [F.desc("growth_rate")] + [F.asc_nulls_first(c) for c in GROUP]
    out = out.orderBy(*order)
    return out.limit(limit) if limit else out


def growth_runs(kw: DataFrame, first: _dt.datetime, last: _dt.datetime, time_window: str = "hourly",
                growth_threshold: float = 0.5, region: str | None = None, category: str | None = None, min_likes: int = 0,
                min_comments: int = 0, min_shares: int = 0, min_views: int = 0, limit: int = 20) -> DataFrame:
    """What ``growth`` gives for every scheduled run at ``first``, ``first`` + 1 period, ... up to ``last``: the catch-up of
    missed runs, and the history of trends, in one scan and one aggregate instead of a scan per run.

    A fact counts as current in the run whose window holds it and as previous in the next one; both counts are summed map-side by
    (keyword, region, category, run). Output: ``time_bucket`` (the run), the columns of ``growth`` and ``rank`` within the run.
    """
    lo, _, _ = window_bounds(first, time_window)
    period = WINDOWS[time_window]
    micros = period // _dt.timedelta(microseconds=1)
    runs = (last - first) // period
    if runs < 0:
        raise ValueError("last lies before first")
    base = with_stat_texts(detected_between(kw, lo, first + runs * period))
    base = base.filter(engagement_predicate(min_likes, min_comments, min_shares, min_views))
    base = filter_equal(base, region, category)
    since = F.unix_micros(F.col("detected_at").cast("timestamp")) - F.unix_micros(ts_lit(first).cast("timestamp"))
    run = ((since - F.pmod(since, F.lit(micros))) / F.lit(micros)).cast("long") + 1  # whole periods divide exactly
    counted = base.select(*GROUP, F.explode(F.array(
        F.struct(run.alias("run"), F.lit(1).alias("now"), F.lit(0).alias("before")),
        F.struct((run + 1).alias("run"), F.lit(0).alias("now"), F.lit(1).alias("before")))).alias("r"))
    agg = (counted.where(F.col("r.run").between(0, runs)).groupBy(*GROUP, F.col("r.run").alias("run"))
                  .agg(F.sum("r.now").cast("double").alias("current_mentions"), F.sum("r.before").cast("double").alias("_prev")))
    null_key = F.col("keyword").isNull() | F.col("region").isNull() | F.col("category").isNull()
    out = (agg.filter(F.col("current_mentions") > 0)
              .withColumn("prev_mentions", F.when(null_key, F.lit(0.0)).otherwise(F.col("_prev")))
              .withColumn("growth_rate", growth_case(F.col("current_mentions"), F.col("prev_mentions")))
              .filter(F.col("growth_rate") >= F.lit(float(growth_threshold))))
    best = Window.partitionBy("run").orderBy(F.desc("growth_rate"), *[F.asc_nulls_first(c) for c in GROUP])
    out = out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)
    at = F.timestamp_micros(F.unix_micros(ts_lit(first).cast("timestamp")) + F.col("run") * F.lit(micros))
    return out.select(at.cast(base.schema["detected_at"].dataType).alias("time_bucket"), *GROUP, "current_mentions", "prev_mentions",
                      "growth_rate", "rank")


def trending_rows(result: DataFrame, as_of: _dt.datetime, time_window: str) -> DataFrame:
    """Rows appended to the trending table (time_bucket = end of current window)."""
    return result.select(
        *GROUP, ts_lit(as_of).alias("time_bucket"),
        F.col("current_mentions").cast("int").alias("mentions"), "growth_rate",
        F.lit(time_window).alias("time_window"), ts_lit(as_of).alias("detected_at"))


def backtest(kw: DataFrame, as_of: _dt.datetime, days_back: int = 7,
             horizon_days: int = 3) -> DataFrame:
    """C4: cumulative keyword counts at t0 = as_of - days_back and t1 = t0 + horizon.

    One scan (pushed bound ``detected_at <= t1``), two conditional counts; keywords
    first seen after t0 are absent, as in the reference.
    """
    t0 = as_of - _dt.timedelta(days=days_back)
    t1 = t0 + _dt.timedelta(days=horizon_days)
    ts = F.col("detected_at")
    hi = max(t0, t1)
    agg = (detected_between(kw, hi=hi, hi_inclusive=True)
             .groupBy("keyword")
             .agg(F.count_if(ts <= ts_lit(t0)).alias("count_then"),
                  F.count_if(ts <= ts_lit(t1)).alias("count_future")))
    return (agg.filter(F.col("count_then") > 0)
               .withColumn("growth", (F.col("count_future") - F.col("count_then"))
                           / F.greatest(F.col("count_then"), F.lit(1)))
               .orderBy(F.desc("growth"), F.asc_nulls_first("keyword")))


def daily_counts(facts: DataFrame) -> DataFrame:
    """Mentions per (detected_date, keyword), the delta that a day adds to the cumulative counts."""
    return (facts.groupBy(F.to_date("detected_at").alias("detected_date"), "keyword")
                 .agg(F.count(F.lit(1)).alias("mentions")))


def backtest_delta(daily: DataFrame, facts: DataFrame, as_of: _dt.datetime, days_back: int = 7,
                   horizon_days: int = 3) -> DataFrame:
    """C4 from stored ``daily_counts`` (partitioned by ``detected_date``): whole days below a cut-off add up from the
    deltas; of the facts only the cut-offs' own days are read (date partitions), for the rows up to
    the cut-off's time of day. Both cut-offs are conditional sums over the same rows, so the counts
    of the first are the running sum that the second goes on from."""
    t0 = as_of - _dt.timedelta(days=days_back)
    t1 = t0 + _dt.timedelta(days=horizon_days)
    day, ts = F.col("detected_date"), F.col("detected_at")
    later = max(t0, t1)
    whole = daily.where(day < F.lit(later.date())).select(
        "keyword", *[F.when(day < F.lit(t.date()), F.col("mentions")).otherwise(F.lit(0).cast("long")).alias(n)
                     for t, n in ((t0, "count_then"), (t1, "count_future"))])
    days = facts.where(day.isin([t0.date(), t1.date()]) & (ts <= ts_lit(later))).select(
        "keyword", *[((day == F.lit(t.date())) & (ts <= ts_lit(t))).cast("long").alias(n)
                     for t, n in ((t0, "count_then"), (t1, "count_future"))])
    agg = whole.unionByName(days).groupBy("keyword").agg(F.sum("count_then").alias("count_then"),
                                                         F.sum("count_future").alias("count_future"))
    return (agg.filter(F.col("count_then") > 0)
               .withColumn("growth", (F.col("count_future") - F.col("count_then"))
                           / F.greatest(F.col("count_then"), F.lit(1)))
               .orderBy(F.desc("growth"), F.asc_nulls_first("keyword")))


METRIC_NAMES = ["videos_processed_last_24h", "keywords_extracted_last_24h",
                "unique_keywords_last_24h", "rows_missing_stats"]


def metrics(kw: DataFrame, as_of: _dt.datetime, lookback: _dt.timedelta = _dt.timedelta(days=1)) -> DataFrame:
    """Four pipeline metrics, returned as (metric_name, metric_value, metric_time) rows.

    On the stored fact table (date-partitioned) the three recent metrics read only
    the lookback's date partitions, and the all-time ``stats IS NULL`` count is a
    pushed parquet filter that skips every row group without a NULL (footer
    statistics), instead of decompressing the whole stats column each run. On a
    derived frame neither applies, so all four come from one pass.
    """
    lo = as_of - lookback
    recent = F.col("detected_at") >= ts_lit(lo)
    distinct_videos = lambda c: F.count_distinct(F.when(c, F.col("video_id")))
    distinct_kws = lambda c: F.count_distinct(F.when(c, F.col("keyword")))
    if "detected_date" not in kw.columns:
        one = kw.agg(distinct_videos(recent).alias("m0"), F.count_if(recent).alias("m1"),
                     distinct_kws(recent).alias("m2"),
                     F.count_if(F.col("stats").isNull()).alias("m3"))
        return _stack(one, range(4), as_of)
    last = F.lit(True)
    recent_rows = detected_between(kw, lo=lo).agg(
        distinct_videos(last).alias("m0"), F.count(F.lit(1)).alias("m1"), distinct_kws(last).alias("m2"))
    missing = kw.filter(F.col("stats").isNull()).agg(F.count(F.lit(1)).alias("m3"))
    return _stack(recent_rows, range(3), as_of).unionByName(_stack(missing, [3], as_of))


def _stack(one: DataFrame, idx, as_of: _dt.datetime) -> DataFrame:
    idx = list(idx)
    stack = (f"stack({len(idx)}, " + ", ".join(f"'{METRIC_NAMES[i]}', CAST(m{i} AS DOUBLE)" for i in idx)
             + ") AS (metric_name, metric_value)")
    return one.selectExpr(stack).withColumn("metric_time", ts_lit(as_of))


def hourly_counts(kw: DataFrame) -> DataFrame:
    """Mentions per (hour of posted_at, keyword, region, category).

    NULL posted_at forms its own (NULL) bucket, like SQL GROUP BY.
    """
    return (kw.groupBy(F.date_trunc("hour", F.col("posted_at")).cast("timestamp_ntz").alias("bucket"),
                       "keyword", "region", "category")
              .agg(F.count(F.lit(1)).alias("mentions")))
