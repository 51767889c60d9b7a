"""The read side as a user calls it: the API's keyword report and export, and
the dashboard's chain (load -> selections -> row top-N -> reports).

Each function composes the operators into DataFrames (nothing is collected or cached here; only
``dashboard_reports`` writes its selection); the caller decides which ones to run or write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.operators import clean as C
from kwpulse.operators import filters as FL
from kwpulse.operators import reports as R
from kwpulse.sources.files import stored


def api_keywords(clean: DataFrame, regions: Sequence[str] | None = None,
                 categories: Sequence[str] | None = None, modalities: Sequence[str] | None = None,
                 start=None, end=None, top_n: int = 50) -> DataFrame:
    """The API's keyword report: optional IN lists and inclusive date range, then
    per keyword engagement, plays and distinct videos, top N."""
    rows = FL.filter_dates(FL.filter_in(clean, regions, categories, modalities), start, end)
    return R.api_keywords(rows, top_n)


def api_export(clean: DataFrame, path: str, regions: Sequence[str] | None = None,
               categories: Sequence[str] | None = None, modalities: Sequence[str] | None = None,
               start=None, end=None) -> None:
    """The API's CSV export of the filtered rows (a distributed write)."""
    FL.export_filtered(clean, path, regions, categories, modalities, start, end)


def dashboard_window(dash: DataFrame) -> DataFrame:
    """The dashboard frame under its default date range: from the first posting day of the whole
    frame to a day after the last, so every row that has a posting date, in one scan."""
    return dash.filter(F.col("posted_at").isNotNull())


def dashboard_rows(clean: DataFrame, regions: Sequence[str] | None = None,
                   categories: Sequence[str] | None = None, modalities: Sequence[str] | None = None,
                   start=None, end=None, top_n: int | None = 20) -> DataFrame:
    """Load step (backfill, region normalisation, iso3), selections, date range
    (the defaults come from the whole frame), then the row top-N by engagement."""
    dash = C.dashboard_frame(clean)
    rows = FL.filter_in(dash, regions, categories, modalities)
    if start is None and end is None:
        rows = dashboard_window(rows)
    else:
        rows = FL.filter_dates(rows, start, end, end_plus_one_day=True)
    return R.top_rows(rows, top_n)


def dashboard_reports(clean: DataFrame, regions: Sequence[str] | None = None,
                      categories: Sequence[str] | None = None, modalities: Sequence[str] | None = None,
                      start=None, end=None, top_n: int | None = 20,
                      sample_n: int = 200, seed: int = 42) -> dict[str, DataFrame]:
    """Every dashboard panel over the same selected rows, which are written once to the shared folder: the
    facts are scanned once for all panels."""
    rows = stored(dashboard_rows(clean, regions, categories, modalities, start, end, top_n), "dashboard")
    k = top_n or 20
    return {
        "rows": R.row_count(rows),
        "top_keywords": R.top_keywords_modality(rows, k),
        "region_map": R.region_map(rows),
        "scatter": R.scatter(rows, k),
        "category_compare": R.category_compare(rows),
        "sample": R.sample_rows(rows, sample_n, seed),
    }
