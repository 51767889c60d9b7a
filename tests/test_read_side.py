"""The read side as a user calls it (API report/export, dashboard panels)."""

from __future__ import annotations

import __spark_entry__ as E
from conftest import SF_SMALL
from kwpulse.operators import clean as C
from kwpulse.plans import params as P
from kwpulse.plans import read_side as RS
from kwpulse.session import scratch_path
from kwpulse.sources import files as IO
from kwpulse.sources import tables as TB


def _bag(df):
    return sorted(map(repr, df.collect()))


def test_dashboard_defaults_match_registered_queries(spark):
    clean = C.clean(TB.keyword_facts(spark, SF_SMALL))
    panels = RS.dashboard_reports(clean, top_n=P.DASH_TOP_N)
    q = E.queries()
    assert _bag(panels["top_keywords"]) == _bag(q["dashboard_keywords"](spark, SF_SMALL))
    assert _bag(RS.dashboard_rows(clean, top_n=P.DASH_TOP_N)) == _bag(q["top_rows"](spark, SF_SMALL))
    full = RS.dashboard_reports(clean, top_n=None)
    assert _bag(full["rows"]) == _bag(q["row_count"](spark, SF_SMALL))
    assert full["sample"].count() == 200
    for name in ("region_map", "scatter", "category_compare"):
        assert panels[name].columns and full[name].count() >= panels[name].count()


def test_api_keywords_with_selections_brute_force(spark):
    clean = C.clean(TB.keyword_facts(spark, SF_SMALL))
    got = RS.api_keywords(clean, P.REGIONS, None, P.MODALITIES, P.START, P.END, top_n=10).collect()
    pdf = clean.toPandas()
    sel = pdf[pdf.region.isin(P.REGIONS) & pdf.modality.isin(P.MODALITIES)
              & (pdf.posted_at >= P.START) & (pdf.posted_at <= P.END)]
    want = (sel.groupby("keyword").agg(total_engagement=("engagement_total", "sum"),
                                       count_videos=("video_id", "nunique"))
               .reset_index().sort_values(["total_engagement", "keyword"], ascending=[False, True])
               .head(10))
    assert [r.keyword for r in got] == want.keyword.tolist()
    assert [r.count_videos for r in got] == want.count_videos.tolist()


def test_api_export_roundtrip(spark):
    clean = C.clean(TB.keyword_facts(spark, SF_SMALL))
    path = scratch_path(spark, "api-export")
    RS.api_export(clean, path, regions=P.REGIONS)
    back = IO.read_keywords_csv(spark, path, clean=True)
    assert back.count() == clean.filter(clean.region.isin(P.REGIONS)).count()
