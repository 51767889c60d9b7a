"""Exact distinct counts that add up over days (A3, A5, A8): a bitmap over dense ids for each day.

A dictionary gives each value a positive id that stays: ids are dealt in hash buckets, so that no task numbers all
values. A day's set of values is a few 4 KB bitmaps, built by a map-side aggregate; sets of days are their OR, and a count
is a sum of bit counts. No ``Expand`` of all rows for two distincts, and history is not read again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.functions.exprs import ts_lit
from kwpulse.operators.growth import METRIC_NAMES, _stack

BUCKETS = 64


def extended_ids(values: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``value, id`` for every distinct non-null ``value``: those of ``known`` keep theirs, new ones follow in their bucket."""
    new = values.select("value").where("value IS NOT NULL").distinct()
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    if known is not None:
        new = new.join(known, "value", "left_anti")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("value"))
    new = new.withColumn("bucket", bucket).withColumn("place", place)
    if known is None:
        return new.select("value", ((F.col("place") - 1) * buckets + F.col("bucket") + 1).cast("long").alias("id"))
    held = known.groupBy(bucket.alias("bucket")).agg(F.max("id").alias("top"))  # one row a bucket
    start = F.when(F.col("top").isNull(), 0).otherwise(F.floor((F.col("top") - 1) / buckets) + 1)
    new = new.join(F.broadcast(held), "bucket", "left").select(
        "value", ((start + F.col("place") - 1) * buckets + F.col("bucket") + 1).cast("long").alias("id"))
    return known.unionByName(new)


def daily_bitmaps(facts: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``detected_date, bucket, bits``: the values of ``column`` by day. The values are made distinct per day first, so that the
    dictionary meets them once, however often they stand."""
    days = facts.select(F.to_date("detected_at").alias("detected_date"), F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    rows = days.join(ids, "value")
    return rows.groupBy("detected_date", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def distinct_count(bitmaps: DataFrame) -> DataFrame:
    """One row, ``n``: the distinct values over all days of ``bitmaps``."""
    both = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return both.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def metrics(facts: DataFrame, bitmaps: dict[str, DataFrame], ids: dict[str, DataFrame], as_of: _dt.datetime,
            lookback: _dt.timedelta = _dt.timedelta(days=1)) -> DataFrame:
    """C5 with the two distinct counts (``video_id``, ``keyword``) from daily bitmaps. Only a day that the lookback begins
    within is taken from the facts."""
    lo = as_of - lookback
    midnight = lo == _dt.datetime.combine(lo.date(), _dt.time())
    parts = []
    for i, c in ((0, "video_id"), (2, "keyword")):
        rows = bitmaps[c].where(F.col("detected_date") >= F.lit(lo.date()) if midnight else F.col("detected_date") > F.lit(lo.date()))
        if not midnight:
            first = facts.where((F.col("detected_at") >= ts_lit(lo)) & (F.to_date("detected_at") == F.lit(lo.date())))
            rows = rows.select("detected_date", "bucket", "bits").unionByName(daily_bitmaps(first, c, ids[c]))
        parts.append(_stack(distinct_count(rows).withColumnRenamed("n", f"m{i}"), [i], as_of))
    recent = facts.where(F.col("detected_at") >= ts_lit(lo)).agg(F.count(F.lit(1)).alias("m1"))
    missing = facts.where(F.col("stats").isNull()).agg(F.count(F.lit(1)).alias("m3"))
    return (parts[0].unionByName(_stack(recent, [1], as_of)).unionByName(parts[1]).unionByName(_stack(missing, [3], as_of))
            .orderBy(F.array_position(F.array(*[F.lit(n) for n in METRIC_NAMES]), F.col("metric_name"))))
