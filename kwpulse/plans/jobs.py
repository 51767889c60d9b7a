"""Composite jobs (C1-C6): the scheduled chain as Spark batch steps.

Each step reads the previous step's *written* table and writes its own, so a
lost executor or a failed step is recomputed from the last written table, not
from the raw input; the steps can also be scheduled separately. Writers use
Spark's commit protocol (a step's output appears whole or not at all).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.operators import clean as C
from kwpulse.operators import growth as G
from kwpulse.operators import videos as V
from kwpulse.plans import params as P
from kwpulse.session import configure
from kwpulse.sources import files as IO
from kwpulse.sources import runs
from kwpulse.streaming import rollup as RS


def paths(out_dir: str) -> dict[str, str]:
    o = out_dir.rstrip("/")
    return {name: f"{o}/{name}" for name in
            ("facts", "runs", "keywords_csv", "quarantine", "clean", "rollup", "rollup_ckpt",
             "trending", "metrics", "daily")}


def facts_of(spark: SparkSession, out: dict) -> DataFrame:
    """The facts of committed runs."""
    return IO.read_facts(spark, out["facts"], out["runs"])


def extract_job(spark: SparkSession, videos: DataFrame, out: dict, as_of: _dt.datetime,
                top_k: int = P.TOP_K, write_csv: bool = True, demo_limit: int | None = None,
                texts: DataFrame | None = None, stopwords: DataFrame | None = None, run_id: str | None = None) -> None:
    """Metadata records -> keyword facts (parquet by detected date, + CSV);
    malformed records go to the quarantine folder. ``demo_limit`` (T9) keeps the
    first n good records in input order. ``texts`` (X4): transcripts, OCR and the like, keyed
    by ``video_id``, whose keywords join the facts. ``stopwords`` (F15): a table (lang, word) instead
    of the built-in lists.

    A run is known by ``run_id``, by default its ``as_of``. Facts, CSV and quarantined records are written as one
    attempt of it and count from the commit at the end: a run that dies before leaves nothing that readers
    with the ledger see, and a run that is repeated replaces what it wrote before."""
    run_id = run_id or runs.run_of(as_of)
    attempt = runs.new_attempt(run_id)
    good, bad = IO.split_quarantine(videos)
    bad.withColumn(runs.ATTEMPT, F.lit(attempt)).write.mode("append").partitionBy(runs.ATTEMPT).json(out["quarantine"])
    good = V.ensure_entry_id(good)
    if demo_limit:
        good = V.first_entries(good, demo_limit)
    extra = V.entry_texts(good, texts) if texts is not None else None
    facts = IO.with_defaults(V.extract_keyword_facts(good, as_of, top_k, extra, stopwords), as_of)
    IO.write_facts(facts, out["facts"], attempt=attempt)
    if write_csv:
        # S3: this attempt's rows, read back from the written table (one partition), so that the
        # extraction is not computed again
        rows = spark.read.schema(IO.facts_schema(runs.ATTEMPT)).parquet(out["facts"])
        rows = G.detected_between(rows, as_of, as_of, hi_inclusive=True).where(F.col(runs.ATTEMPT) == attempt)
        IO.write_keywords_csv(rows.drop("detected_date", runs.ATTEMPT), out["keywords_csv"], attempt=attempt)
    runs.commit(spark, out["runs"], run_id, attempt)


def clean_job(spark: SparkSession, out: dict, as_of: _dt.datetime | None = None) -> None:
    """Facts -> clean table (counts + KPIs), partitioned like the facts.

    Cleaning is per row, so a date partition of the clean table is a function of
    the same date partition of the facts. With ``as_of`` only the run's date is
    recomputed and its partition replaced (dynamic partition overwrite): the step
    costs one day of facts, and rerunning it after a failure replaces, never
    duplicates. Without ``as_of`` every date is rebuilt.
    """
    facts = facts_of(spark, out)
    if as_of is not None:
        facts = facts.filter(F.col("detected_date") == F.lit(as_of.date()))
    (C.clean(facts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("detected_date").parquet(out["clean"]))


def rollup_job(spark: SparkSession, out: dict) -> None:
    """Refresh the hourly rollup incrementally (one availableNow stream run over the ledger)."""
    RS.stream_committed_counts(spark, out["facts"], out["runs"], out["rollup"], out["rollup_ckpt"])


def growth_job(spark: SparkSession, out: dict, as_of: _dt.datetime, time_window: str = "hourly",
               growth_threshold: float = 0.5, **kw) -> None:
    """Detect trending keywords and append them to the trending table; a repeated run replaces its rows."""
    res = G.growth(facts_of(spark, out), as_of, time_window, growth_threshold, **kw)
    IO.write_table(G.trending_rows(res, as_of, time_window), out["trending"], run_id=f"{runs.run_of(as_of)}-{time_window}")


def daily_job(spark: SparkSession, out: dict, as_of: _dt.datetime | None = None) -> None:
    """C4's deltas: mentions per day and keyword; with ``as_of`` only that run's date is counted anew and its
    partition replaced."""
    facts = facts_of(spark, out)
    if as_of is not None:
        facts = facts.filter(F.col("detected_date") == F.lit(as_of.date()))
    (G.daily_counts(facts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("detected_date").parquet(out["daily"]))


def backtest_job(spark: SparkSession, out: dict, as_of: _dt.datetime, days_back: int = 7, horizon_days: int = 3) -> DataFrame:
    """C4 from the stored deltas."""
    return G.backtest_delta(spark.read.schema("keyword string, mentions long, detected_date date").parquet(out["daily"]),
                            facts_of(spark, out), as_of, days_back, horizon_days)


def metrics_job(spark: SparkSession, out: dict, as_of: _dt.datetime) -> None:
    """Append the four pipeline metrics; a repeated run replaces its own."""
    IO.write_table(G.metrics(facts_of(spark, out), as_of), out["metrics"], run_id=runs.run_of(as_of))


def run_all(spark: SparkSession, videos_path: str, out_dir: str, as_of: _dt.datetime,
            growth_params: dict | None = None, multiline: bool = False,
            growth_as_of: _dt.datetime | None = None, texts: DataFrame | None = None,
            stopwords: DataFrame | None = None) -> dict[str, str]:
    """Extract -> clean -> rollup refresh -> growth -> metrics, in the scheduler's order,
    with its growth parameters by default (hourly, 0.5, minimums 50/5/2/1000, top 20).

    Growth and metrics look back from ``growth_as_of``, by default a microsecond after the
    extraction's stamp: their windows exclude their end, and the scheduled steps run after the
    extraction, so the rows just extracted are in the current window."""
    configure(spark)
    out = paths(out_dir)
    gp = dict(growth_params or dict(time_window="hourly", growth_threshold=0.5, limit=20,
                                    **P.SCHEDULED_MINIMUMS))
    extract_job(spark, IO.read_videos(spark, videos_path, multiline=multiline), out, as_of, texts=texts, stopwords=stopwords)
    clean_job(spark, out, as_of)
    rollup_job(spark, out)
    later = growth_as_of or as_of + _dt.timedelta(microseconds=1)
    growth_job(spark, out, later, **gp)
    metrics_job(spark, out, later)
    return out
