"""A hot key — one keyword with a third of all fact rows — must not reach a single
task as raw rows: every hash shuffle on keyword-keyed groups carries partial
aggregates, and results stay exact (checked against a pandas brute force)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kwpulse.operators import clean as C
from kwpulse.operators import growth as G
from kwpulse.operators import reports as R
from kwpulse.operators import workbook as W
from kwpulse.plans import params as P
from kwpulse.sources import tables as TB


def _hot(spark):
    kw = TB.keyword_facts(spark, SF_SMALL)
    hot = (F.xxhash64("video_id", "detected_at", "modality") % 3) == 0  # ~ a third of the rows
    return kw.withColumn("keyword", F.when(hot, F.lit("hot")).otherwise(F.col("keyword")))


def _plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def _shuffle_children(df):
    lines = _plan_lines(df)
    return [lines[i + 1] for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]


def test_keyword_shuffles_carry_partial_aggregates(spark):
    kw = _hot(spark)
    clean = C.clean(kw)
    frames = [R.api_keywords(clean), R.top_keywords_modality(clean), R.scatter(clean),
              R.keyword_modality(clean), W.top_keywords_sheet(clean, 10), W.scatter_sheet(clean, 30),
              G.growth(kw, P.AS_OF, "weekly", 0.0), G.backtest(kw, P.AS_OF), G.hourly_counts(kw)]
    for df in frames:
        children = _shuffle_children(df)
        assert children, df
        for child in children:
            assert "Aggregate" in child and ("partial_" in child or "merge_" in child), child


def test_hot_keyword_results_exact(spark):
    clean = C.clean(_hot(spark))
    pdf = clean.select("keyword", "video_id", "engagement_total", "playCount").toPandas()
    hot_share = (pdf.keyword == "hot").mean()
    assert 0.25 < hot_share < 0.42
    want = (pdf.groupby("keyword")
               .agg(total_engagement=("engagement_total", "sum"), plays=("playCount", "sum"),
                    count_videos=("video_id", "nunique"))
               .reset_index().sort_values(["total_engagement", "keyword"], ascending=[False, True])
               .head(50))
    got = pd.DataFrame([r.asDict() for r in R.api_keywords(clean, 50).collect()])
    assert got.keyword.tolist() == want.keyword.tolist()
    assert got.total_engagement.tolist() == want.total_engagement.tolist()
    assert got.count_videos.tolist() == want.count_videos.tolist()
