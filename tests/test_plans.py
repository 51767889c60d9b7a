"""Physical-plan shape: pushdown, pruning, shuffle counts."""

from __future__ import annotations

import datetime as dt

import __spark_entry__ as E
from conftest import SF_SMALL
from kwpulse.operators import clean as C
from kwpulse.operators import extract as X
from kwpulse.operators import growth as G
from kwpulse.operators import workbook as W
from kwpulse.plans import params as P
from kwpulse.plans import read_side as READ
from kwpulse.sources import files as IO
from kwpulse.sources import tables as TB


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange RoundRobin") \
        + plan.count("Exchange SinglePartition") + plan.count("Exchange rangepartitioning")


def test_growth_window_reaches_scan(spark):
    plan = _plan(E.queries()["growth_daily"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-29T00:00)" in plan
    assert "TakeOrderedAndProject" in plan
    assert _shuffles(plan) == 1  # partial aggregate -> one hash exchange


def test_backtest_single_scan_single_shuffle(spark):
    plan = _plan(E.queries()["backtest"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 2  # events + customer, each read once
    assert "LessThanOrEqual(ts,2024-01-27T00:00)" in plan


def test_extraction_one_shuffle_and_group_limit(spark):
    plan = _plan(E.queries()["modality_union"](spark, SF_SMALL))
    assert _shuffles(plan) == 1
    assert "WindowGroupLimit" in plan
    assert "BroadcastHashJoin" in plan  # stopword table


def test_column_pruning_events(spark):
    plan = _plan(E.queries()["backtest"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_stored_facts_prune_date_partitions(spark, tmp_path):
    """Time windows on the stored fact table prune ``detected_date`` partitions,
    and pruning does not change the result."""
    path = str(tmp_path / "facts")
    kw = TB.keyword_facts(spark, SF_SMALL)
    IO.write_facts(kw, path, mode="overwrite")
    stored = IO.read_facts(spark, path)
    for df in (G.growth(stored, P.AS_OF, "daily", 0.0, limit=None),
               G.backtest(stored, P.AS_OF)):
        assert "PartitionFilters: [isnotnull(detected_date" in _plan(df)
    a = G.growth(stored, P.AS_OF, "weekly", 0.0, limit=None).collect()
    b = G.growth(kw, P.AS_OF, "weekly", 0.0, limit=None).collect()
    bag = lambda rows: sorted(map(repr, rows))
    assert bag(a) == bag(b) and a
    assert bag(G.backtest(stored, P.AS_OF).collect()) == bag(G.backtest(kw, P.AS_OF).collect())


def test_stored_metrics_prune_and_push_null_count(spark, tmp_path):
    path = str(tmp_path / "facts")
    kw = TB.keyword_facts(spark, SF_SMALL)
    IO.write_facts(kw, path, mode="overwrite")
    stored = IO.read_facts(spark, path)
    plan = _plan(G.metrics(stored, P.AS_OF))
    assert "PushedFilters: [IsNull(stats)]" in plan
    assert "PartitionFilters: [isnotnull(detected_date" in plan
    got = {r.metric_name: r.metric_value for r in G.metrics(stored, P.AS_OF).collect()}
    want = {r.metric_name: r.metric_value for r in G.metrics(kw, P.AS_OF).collect()}
    assert got == want and set(got) == set(G.METRIC_NAMES)


def test_fact_rows_never_sort_aggregated(spark):
    """Aggregates over fact rows are hash aggregates (map-side combine, no sort);
    a string-valued pick (``min_by``) only ever runs on pre-aggregated rows."""
    for name in ("scatter", "api_keywords", "top_keywords_modality", "dominant_modality",
                 "category_compare", "region_map", "keyword_region", "keyword_modality"):
        # the workbook's sheets write these aggregates and rank from them
        df = getattr(W, name)(C.clean(TB.keyword_facts(spark, SF_SMALL))) if hasattr(W, name) else E.queries()[name](spark, SF_SMALL)
        lines = _plan(df).split("\n")
        fact_aggs = [ln for ln in lines if "partial_sum(engagement_total" in ln
                     or "partial_sum(playCount" in ln or "partial_avg(engagement_rate" in ln]
        assert fact_aggs, name
        assert all("HashAggregate" in ln and "SortAggregate" not in ln for ln in fact_aggs), name


def test_single_scan_reports(spark):
    """Each of these reads its source table once (no union of scans, no join back)."""
    q = E.queries()
    for name, table in (("filter_options", "events.parquet"), ("language_confusion", "documents.parquet"),
                        ("scatter", "events.parquet")):
        plan = _plan(q[name](spark, SF_SMALL))
        assert plan.count(f"{table}]") == 1, name


def test_workbook_sheets_scan_the_facts_once_and_gather_nothing(spark):
    clean = C.clean(TB.keyword_facts(spark, SF_SMALL))
    assert all(_plan(f(clean)).count("events.parquet]") == 1 for f in (W.keyword_modality, W.keyword_region))
    for name in ("wb_top_keywords", "wb_top_keywords_all", "wb_scatter"):  # the rest reads the written aggregate
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "events.parquet]" not in plan and "collect_list" not in plan and "TakeOrderedAndProject" in plan, name


def test_panels_share_one_selection(spark):
    """One scan of the facts writes the selected rows; no panel reads the facts again."""
    clean = C.clean(TB.keyword_facts(spark, SF_SMALL))
    assert _plan(READ.dashboard_rows(clean)).count("events.parquet]") == 1
    panels = READ.dashboard_reports(clean)
    assert len(panels) == 6 and all(
        "events.parquet]" not in _plan(p) and _plan(p).count("FileScan parquet") == 1 for p in panels.values())


def test_region_lookup_after_the_aggregate(spark):
    plan = _plan(E.queries()["region_map"](spark, SF_SMALL))
    joins = [ln for ln in plan.split("\n") if "Join" in ln and "alpha2" in ln]
    assert len(joins) == 1 and plan.index(joins[0]) < plan.index("partial_avg(engagement_rate")  # the last step is printed first


def test_stopword_table_joins_by_its_counted_size(spark, monkeypatch):
    texts = X.with_frame_key(TB.modal_texts(spark, SF_SMALL))
    words = spark.createDataFrame([("en", "the"), ("en", "of"), ("de", "und"), ("xx", None), ("xx", "The")], "lang string, word string")
    small = X.keywords(texts, X.TEXT_KEYS, 5, words)
    assert "BroadcastHashJoin" in _plan(small) and _shuffles(_plan(small)) == 1
    want = sorted(map(repr, small.collect()))
    monkeypatch.setattr(X, "STOPWORD_BROADCAST", 1)
    large = X.keywords(texts, X.TEXT_KEYS, 5, words)
    assert "SortMergeJoin" in _plan(large) and "BroadcastHashJoin" not in _plan(large)
    assert sorted(map(repr, large.collect())) == want and want


def test_backtest_delta_reads_the_days_of_its_cut_offs(spark, tmp_path):
    facts, daily = str(tmp_path / "facts"), str(tmp_path / "daily")
    IO.write_facts(TB.keyword_facts(spark, SF_SMALL), facts)
    stored = IO.read_facts(spark, facts)
    G.daily_counts(stored).write.partitionBy("detected_date").parquet(daily)
    deltas = spark.read.parquet(daily)
    for as_of in (P.AS_OF, P.AS_OF - dt.timedelta(hours=7, minutes=11)):
        df = G.backtest_delta(deltas, stored, as_of)
        assert "detected_date#" in _plan(df) and "INSET" in _plan(df).upper() or " IN (" in _plan(df)
        assert sorted(map(repr, df.collect())) == sorted(map(repr, G.backtest(stored, as_of).collect()))
