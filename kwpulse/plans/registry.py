"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables (or frames Spark derives from them) in
full; parameters live in ``kwpulse.plans.params`` and are shared with the
DuckDB oracle (``kwpulse.plans.oracle``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.operators import bitmaps as B
from kwpulse.operators import clean as C
from kwpulse.operators import extract as X
from kwpulse.operators import filters as FL
from kwpulse.operators import growth as G
from kwpulse.operators import language as LG
from kwpulse.operators import reports as R
from kwpulse.operators import videos as V
from kwpulse.operators import workbook as W
from kwpulse.plans import jobs as J
from kwpulse.plans import params as P
from kwpulse.plans.read_side import dashboard_window
from kwpulse.session import configure, scratch_path
from kwpulse.sources import files as IO
from kwpulse.sources import runs
from kwpulse.sources import tables as TB
from kwpulse.streaming import rollup as RS

Query = Callable[[SparkSession, str], DataFrame]


def _kw(spark, sf):
    return TB.keyword_facts(configure(spark), sf)


def _clean(spark, sf):
    return C.clean(_kw(spark, sf))


def _dash(spark, sf):
    return C.dashboard_frame(_clean(spark, sf))


def _growth(name: str) -> Query:
    args = dict(P.GROWTH[name])

    def q(spark, sf):
        a = dict(args)
        return G.growth(_kw(spark, sf), P.AS_OF, a.pop("time_window"),
                        growth_threshold=a.pop("threshold"), **a)
    return q


def _catch_up(name: str) -> Query:
    def q(spark, sf):
        a = dict(P.CATCH_UP[name])
        return G.growth_runs(_kw(spark, sf), growth_threshold=a.pop("threshold"), **a)
    return q


def _growth_rows(spark, sf):
    a = dict(P.GROWTH_ROWS)
    tw = a.pop("time_window")
    res = G.growth(_kw(spark, sf), P.AS_OF, tw, growth_threshold=a.pop("threshold"), **a)
    return G.trending_rows(res, P.AS_OF, tw)


def _csv_roundtrip(spark, sf):
    path = scratch_path(spark, "kw-csv")
    IO.write_keywords_csv(_kw(spark, sf), path, mode="overwrite")
    return IO.csv_as_facts(IO.read_keywords_csv(spark, path))


def _export_filtered(spark, sf):
    """S11 written as CSV and read back through the typed clean-CSV scan."""
    path = scratch_path(spark, "export")
    FL.export_filtered(_clean(spark, sf), path, P.REGIONS, P.CATEGORIES, P.MODALITIES)
    return IO.csv_as_facts(IO.read_keywords_csv(spark, path, clean=True))


def _hourly_stream(spark, sf):
    facts = scratch_path(spark, "facts")
    IO.write_facts(_kw(spark, sf), facts, mode="overwrite")
    sink, ckpt = scratch_path(spark, "rollup"), scratch_path(spark, "rollup-ckpt")
    RS.stream_hourly_counts(spark, facts, sink, ckpt)
    return RS.read_rollup(spark, sink)


def _stored(report) -> Query:
    """A report over the written, date-partitioned fact table (its pruned path)."""
    def q(spark, sf):
        path = scratch_path(spark, "facts")
        IO.write_facts(_kw(spark, sf), path, mode="overwrite")
        return report(IO.read_facts(spark, path))
    return q


def _run_all_trending(spark, sf):
    """Metadata as JSON lines -> extraction -> the scheduler's growth step over the rows just
    extracted -> the trending table."""
    src, out = scratch_path(spark, "videos"), J.paths(scratch_path(spark, "run"))
    _payloads(spark, sf).drop("entry_id").write.json(src)
    J.extract_job(spark, IO.read_videos(spark, src), out, P.AS_OF, write_csv=False)
    J.growth_job(spark, out, P.AS_OF + _dt.timedelta(microseconds=1), "hourly", 0.5, limit=20, **P.SCHEDULED_MINIMUMS)
    return spark.read.parquet(out["trending"]).select("keyword", "region", "category", "mentions", "growth_rate")


def _extract_retry(spark, sf):
    """C1 with a run that died before its commit, was repeated, and then repeated once more: its facts count once."""
    out = J.paths(scratch_path(spark, "retried"))
    videos = _payloads(spark, sf)
    dead = runs.new_attempt(runs.run_of(P.AS_OF))
    IO.write_facts(V.extract_keyword_facts(videos, P.AS_OF, P.TOP_K), out["facts"], attempt=dead)
    for _ in range(2):
        J.extract_job(spark, videos, out, P.AS_OF, write_csv=False)
    return J.facts_of(spark, out).drop("detected_date")


def _extract_with_texts(spark, sf):
    """Keyword facts of the metadata and of the frames and transcripts that carry its video ids."""
    videos = _payloads(spark, sf)
    texts = V.entry_texts(videos, TB.modal_texts(spark, sf, ("conversations", "benchmark")))
    return V.extract_keyword_facts(videos, P.AS_OF, P.TOP_K, texts)


def _metadata_append(spark, sf):
    """Records written, some of them appended once more (duplicates stay), all read back."""
    path = scratch_path(spark, "metadata")
    rows = _payloads(spark, sf).drop("entry_id")
    IO.append_videos(rows, path)
    IO.append_videos(rows.where(F.col("region") == "DE"), path)
    good, _ = IO.split_quarantine(IO.read_videos(spark, path))
    return V.flatten_payload(good)


def _metrics_table(spark, sf):
    """The metrics of two runs, one of them repeated, as the table holds them."""
    path, facts = scratch_path(spark, "metrics"), IO.stored(_kw(spark, sf), "facts")
    for as_of in (P.AS_OF, P.EARLIER, P.AS_OF):
        IO.write_table(G.metrics(facts, as_of), path, run_id=runs.run_of(as_of))
    return spark.read.parquet(path).drop("run_id")


def _csv_offsets(spark, sf):
    """Timestamps spelled with an offset, as a database writes them."""
    path = scratch_path(spark, "kw-csv")
    spelled = lambda c: F.concat(F.date_format(F.col(c) + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    IO.write_keywords_csv(_kw(spark, sf).withColumns({c: spelled(c) for c in ("detected_at", "posted_at")}), path)
    return IO.csv_as_facts(IO.read_keywords_csv(spark, path))


def _video_array(spark, sf):
    """The payloads as JSON array files, one a task, read back in byte ranges."""
    def arrays(batches):
        begun = False
        for b in batches:
            for r in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([("," if begun else "[") + r])], names=["value"])
                begun = True
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    path = scratch_path(spark, "arrays")
    rows = _payloads(spark, sf).drop("entry_id")
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).mapInArrow(arrays, "value string").write.text(path)
    good, _ = IO.split_quarantine(IO.read_videos(spark, path, multiline=True))
    return V.flatten_payload(good)


def _language_model(spark, sf):
    """A trigram model fitted on the documents of eleven sixteenths of the ids' hashes, applied to all of them."""
    docs = TB.read_table(configure(spark), sf, "documents", "doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "5")
    model = LG.fit(docs.where(~F.coalesce("held_out", F.lit(True))))
    found = LG.languages(docs.withColumnRenamed("lang", "lang_true"), ["doc_id", "lang_true", "held_out"], model)
    return found.groupBy("lang_true", "held_out", F.col("lang").alias("lang_detected")).agg(F.count(F.lit(1)).alias("docs"))


def _corpus_stopwords(spark, sf):
    """keywords of all texts under a stopword table that the documents give."""
    table = X.corpus_stopwords(TB.read_table(configure(spark), sf, "documents", "text", "lang"), P.STOPWORD_SHARE)
    return X.modal_keywords(TB.modal_texts(spark, sf), P.TOP_K, table)


def _backtest_delta(spark, sf):
    """C4 from stored daily counts; the facts are read for the days of the two cut-offs only."""
    facts, daily = scratch_path(spark, "facts"), scratch_path(spark, "daily")
    IO.write_facts(_kw(spark, sf), facts, mode="overwrite")
    stored = IO.read_facts(spark, facts)
    G.daily_counts(stored).write.partitionBy("detected_date").parquet(daily)
    deltas = spark.read.schema("keyword string, mentions long, detected_date date").parquet(daily)
    return G.backtest_delta(deltas, stored, P.AS_OF, P.BACKTEST_DAYS_BACK, P.BACKTEST_HORIZON)


def _metrics_bitmaps(spark, sf):
    """C5 with exact distinct counts from daily bitmaps, of a dictionary that grew in two steps."""
    facts = IO.stored(_kw(spark, sf), "facts")
    early = facts.where(F.col("detected_at") < P.END)
    ids, maps = {}, {}
    for c in ("video_id", "keyword"):
        first = IO.stored(B.extended_ids(early.select(F.col(c).alias("value"))), "ids")
        ids[c] = IO.stored(B.extended_ids(facts.select(F.col(c).alias("value")), first), "ids")
        maps[c] = IO.stored(B.daily_bitmaps(facts, c, ids[c]), "bitmaps")
    return B.metrics(facts, maps, ids, P.AS_OF)


def _rollup_folded(spark, sf):
    """R1 refreshed, folded, refreshed with more facts, and folded only half again, as after a crash."""
    facts, sink, ckpt = (scratch_path(spark, n) for n in ("facts", "rollup", "rollup-ckpt"))
    rows = IO.stored(_kw(spark, sf), "kw")
    for late in (False, True):
        IO.write_facts(rows.where((F.col("detected_at") >= P.START) == late), facts)
        RS.stream_hourly_counts(spark, facts, sink, ckpt)
        RS.write_fold(spark, sink) if late else RS.fold_rollup(spark, sink)
    return RS.read_folded(spark, sink)


def _sample_size(spark, sf):
    """T8 by its invariants: how many rows are drawn, and how many of them are not input rows."""
    rows = dashboard_window(_dash(spark, sf))
    drawn = R.sample_rows(rows, P.SAMPLE_N, P.SAMPLE_SEED)
    extra = drawn.exceptAll(rows).agg(F.count(F.lit(1)).alias("foreign_rows"))
    return drawn.agg(F.count(F.lit(1)).alias("sampled")).join(extra)


def _payloads(spark, sf):
    return TB.video_payloads(configure(spark), sf)


def _quarantine(spark, sf):
    raw = _payloads(spark, sf)
    line = F.to_json(F.struct("entry_id", "id", "desc", "region", "video"))
    cut = F.when(F.col("entry_id") % 17 == 0,
                 F.expr("substring(_l, 1, length(_l) div 2)")).otherwise(F.col("_l"))
    lines = raw.select("entry_id", line.alias("_l")).select("entry_id", cut.alias("line"))
    parsed = IO.parse_video_lines(lines)
    bad = F.col(IO.CORRUPT).isNotNull()
    return parsed.select(
        "entry_id", F.when(bad, "quarantined").otherwise("ok").alias("status"),
        F.when(~bad, V.video_id(parsed)).alias("video_id"))


def _docs(spark, sf):
    return X.with_frame_key(TB.modal_texts(configure(spark), sf, ("documents",)))


def _token_freq(spark, sf):
    return X.token_freq(_docs(spark, sf), X.TEXT_KEYS).select("video_id", "token", "freq", "first_pos")


def _detect_language(spark, sf):
    return X.text_languages(_docs(spark, sf), X.TEXT_KEYS).select("video_id", "lang")


def _language_confusion(spark, sf):
    """Detected vs labelled language per document. The label rides along as one more
    text key, so the documents are scanned once and nothing is joined back."""
    docs = TB.read_table(configure(spark), sf, "documents", "doc_id", "text", "lang").select(
        F.col("doc_id").cast("string").alias("video_id"), F.lit("caption").alias("modality"),
        F.lit(-1).cast("bigint").alias("frame_k"), "text", F.col("lang").alias("lang_true"))
    langs = X.text_languages(docs, [*X.TEXT_KEYS, "lang_true"])
    return (langs.groupBy("lang_true", F.col("lang").alias("lang_detected"))
                 .agg(F.count(F.lit(1)).alias("docs")))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / derivations
        "kw_facts": _kw,
        "stats_expand": lambda s, d: C.expand_stats(_kw(s, d)).select(
            "video_id", "keyword", "modality", "detected_at", "stats", *C.STAT_FIELDS),
        "kpis": _clean,
        "clean_load": _dash,
        "csv_roundtrip": _csv_roundtrip,
        "csv_offsets": _csv_offsets,
        "insert_defaults": lambda s, d: IO.with_defaults(_kw(s, d), P.AS_OF, ("detected_at", "posted_at")),
        "region_norm": lambda s, d: _kw(s, d).groupBy(
            F.col("region").alias("region_raw"),
            C.norm_region(F.col("region")).alias("region")).agg(F.count(F.lit(1)).alias("rows")),
        "iso3": lambda s, d: _dash(s, d).groupBy("region", "iso3").agg(F.count(F.lit(1)).alias("rows")),
        # filters
        "filter_in": lambda s, d: FL.filter_in(_clean(s, d), P.REGIONS, P.CATEGORIES, P.MODALITIES),
        "export_filtered": _export_filtered,
        "filter_dates": lambda s, d: FL.filter_dates(_clean(s, d), P.START, P.END),
        "filter_dates_dashboard": lambda s, d: FL.filter_dates(_clean(s, d), P.START, P.END,
                                                               end_plus_one_day=True),
        "engagement_filter": lambda s, d: FL.engagement_filter(_kw(s, d), **P.SCHEDULED_MINIMUMS),
        # reports
        "api_keywords": lambda s, d: R.api_keywords(_clean(s, d), P.API_TOP_N),
        "keyword_modality": lambda s, d: R.keyword_modality_sheet(_clean(s, d)),
        "dominant_modality": lambda s, d: R.dominant_modality(R.keyword_modality(_clean(s, d))),
        "top_keywords_modality": lambda s, d: R.top_keywords_modality(_clean(s, d), P.DASH_TOP_N),
        "region_map": lambda s, d: R.region_map(C.dashboard_frame(_clean(s, d), with_iso=False)),
        "scatter": lambda s, d: R.scatter(_clean(s, d), P.DASH_TOP_N),
        "category_compare": lambda s, d: R.category_compare(_clean(s, d)),
        "filter_options": lambda s, d: R.filter_options(_dash(s, d)),
        "date_bounds": lambda s, d: R.date_bounds(_clean(s, d)),
        "row_count": lambda s, d: R.row_count(dashboard_window(_dash(s, d))),
        "top_rows": lambda s, d: R.top_rows(dashboard_window(_dash(s, d)), P.DASH_TOP_N),
        "dashboard_keywords": lambda s, d: R.top_keywords_modality(
            R.top_rows(dashboard_window(_dash(s, d)), P.DASH_TOP_N), P.DASH_TOP_N),
        "sample_rows": lambda s, d: R.sample_rows(dashboard_window(_dash(s, d)), P.SAMPLE_N, P.SAMPLE_SEED),
        "region_category_counts": lambda s, d: R.region_category_counts(_kw(s, d)),
        "coverage_grid": lambda s, d: R.coverage_grid(_kw(s, d), P.GRID_REGIONS, P.GRID_CATEGORIES),
        # workbook
        "wb_top_keywords": lambda s, d: W.top_keywords_sheet(_clean(s, d), P.WB_TOP_N,
                                                             P.WB_MIN_TOTAL, P.WB_MAX_TOTAL),
        "wb_top_keywords_all": lambda s, d: W.top_keywords_sheet(_clean(s, d), P.WB_TOP_N),
        "wb_region": lambda s, d: W.region_sheet(_clean(s, d), P.WB_CATEGORIES, P.WB_MODALITIES,
                                                 P.WB_REGION_SET),
        "wb_scatter": lambda s, d: W.scatter_sheet(_clean(s, d), P.WB_SCATTER_TOP_N,
                                                   P.WB_EXCLUDED_REGIONS),
        "wb_category": lambda s, d: W.category_sheet(_clean(s, d)),
        # growth / backtest / metrics / rollup
        **{name: _growth(name) for name in P.GROWTH},
        **{name: _catch_up(name) for name in P.CATCH_UP},
        "growth_rows": _growth_rows,
        "backtest": lambda s, d: G.backtest(_kw(s, d), P.AS_OF, P.BACKTEST_DAYS_BACK, P.BACKTEST_HORIZON),
        "metrics": lambda s, d: G.metrics(_kw(s, d), P.AS_OF),
        "growth_stored": _stored(lambda f: G.growth(f, P.AS_OF, "weekly", 0.5, limit=50, **P.SCHEDULED_MINIMUMS)),
        "backtest_stored": _stored(lambda f: G.backtest(f, P.AS_OF, P.BACKTEST_DAYS_BACK, P.BACKTEST_HORIZON)),
        "metrics_stored": _stored(lambda f: G.metrics(f, P.AS_OF)),
        "backtest_delta": _backtest_delta,
        "metrics_bitmaps": _metrics_bitmaps,
        "run_all_trending": _run_all_trending,
        "extract_retry": _extract_retry,
        "extract_with_texts": _extract_with_texts,
        "metrics_table": _metrics_table,
        "sample_size": _sample_size,
        "hourly_counts": lambda s, d: G.hourly_counts(_kw(s, d)),
        "hourly_counts_stream": _hourly_stream,
        "rollup_folded": _rollup_folded,
        # video metadata path
        "video_array": _video_array,
        "metadata_append": _metadata_append,
        "first_entries": lambda s, d: V.first_entries(_payloads(s, d), P.DEMO_LIMIT).select("entry_id", "id", "region"),
        "video_flatten": lambda s, d: V.flatten_payload(_payloads(s, d)),
        "video_fields": lambda s, d: V.video_records(_payloads(s, d), P.AS_OF).select(
            "entry_id", "video_id", "region", "category", "stats"),
        "posted_at": lambda s, d: V.video_records(_payloads(s, d), P.AS_OF).select(
            "entry_id", "detected_at", "posted_at"),
        "text_sources": lambda s, d: V.text_sources(_payloads(s, d)),
        "extract_keywords": lambda s, d: V.extract_keyword_facts(_payloads(s, d), P.AS_OF, P.TOP_K),
        "quarantine": _quarantine,
        # text path
        "token_freq": _token_freq,
        "detect_language": _detect_language,
        "language_confusion": _language_confusion,
        "language_model": _language_model,
        "keywords_corpus_stopwords": _corpus_stopwords,
        "modality_union": lambda s, d: X.modal_keywords(TB.modal_texts(configure(s), d), P.TOP_K),
    }
    return q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top keywords by engagement (the API's main report) on the whole fact table."""
    return R.api_keywords(_clean(spark, sf_dir), P.API_TOP_N)
