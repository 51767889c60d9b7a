"""Runs that die, are repeated or both: facts, CSV, rollup, trending rows and metrics count once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kwpulse.operators import bitmaps as B
from kwpulse.operators import growth as G
from kwpulse.plans import jobs as J
from kwpulse.plans import params as P
from kwpulse.session import scratch_path
from kwpulse.sources import files as IO
from kwpulse.sources import runs
from kwpulse.sources import tables as TB
from kwpulse.streaming import rollup as RS


def _bag(df):
    return sorted(map(repr, df.collect()))


def _state(spark, out):
    trending = spark.read.parquet(out["trending"]).drop("run_id")
    return {"facts": _bag(J.facts_of(spark, out)), "csv": _bag(IO.read_keywords_csv(spark, out["keywords_csv"], ledger=out["runs"])),
            "clean": _bag(spark.read.parquet(out["clean"])), "rollup": _bag(RS.read_rollup(spark, out["rollup"])),
            "trending": _bag(trending), "metrics": _bag(spark.read.parquet(out["metrics"]).drop("run_id"))}


def test_killed_and_repeated_runs(spark, monkeypatch):
    src = scratch_path(spark, "videos")
    TB.video_payloads(spark, SF_SMALL).drop("entry_id").write.json(src)
    gp = dict(time_window="weekly", growth_threshold=0.0, limit=None)
    once = _state(spark, J.run_all(spark, src, scratch_path(spark, "once"), P.AS_OF, gp))
    root = scratch_path(spark, "often")
    real = runs.commit

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(runs, "commit", killed)
    with pytest.raises(KeyboardInterrupt):  # after facts and CSV are written
        J.run_all(spark, src, root, P.AS_OF, gp)
    monkeypatch.setattr(runs, "commit", real)
    for _ in range(2):  # the repeated run, and a repetition of a run that had committed
        out = J.run_all(spark, src, root, P.AS_OF, gp)
        assert _state(spark, out) == once
    attempts = spark.read.parquet(out["facts"]).select("attempt").distinct().count()
    assert attempts == 3 and all(once.values())


def test_a_repeated_run_replaces_other_rows(spark):
    """A run repeated on mended input: the rollup takes the earlier attempt's counts back."""
    out = J.paths(scratch_path(spark, "mended"))
    videos = TB.video_payloads(spark, SF_SMALL)
    J.extract_job(spark, videos.where("entry_id < 60"), out, P.AS_OF)
    J.rollup_job(spark, out)
    J.extract_job(spark, videos.where("entry_id >= 30"), out, P.AS_OF)
    J.extract_job(spark, videos.where("entry_id < 10"), out, P.AS_OF + dt.timedelta(hours=1))
    J.rollup_job(spark, out)
    facts = J.facts_of(spark, out)
    assert _bag(RS.read_rollup(spark, out["rollup"]).select("bucket", "keyword", "region", "category", "mentions")) == _bag(G.hourly_counts(facts))
    J.daily_job(spark, out)
    later = P.AS_OF + dt.timedelta(days=2)
    assert _bag(J.backtest_job(spark, out, later, 1, 1)) == _bag(G.backtest(facts, later, 1, 1))


def test_fold_and_crash(spark):
    facts, sink, ckpt = (scratch_path(spark, n) for n in ("facts", "rollup", "ckpt"))
    kw = TB.keyword_facts(spark, SF_SMALL)
    days = [P.START, P.END, P.AS_OF]
    for i, hi in enumerate(days):
        lo = days[i - 1] if i else dt.datetime(1970, 1, 1)
        IO.write_facts(kw.where((F.col("detected_at") >= lo) & (F.col("detected_at") < hi)), facts)
        RS.stream_hourly_counts(spark, facts, sink, ckpt)
        want = _bag(RS.read_rollup(spark, sink))
        assert _bag(RS.read_folded(spark, sink)) == want
        RS.write_fold(spark, sink)  # a crash between the two halves
        assert _bag(RS.read_folded(spark, sink)) == want
        RS.fold_rollup(spark, sink)
        RS.fold_rollup(spark, sink)
        assert _bag(RS.read_folded(spark, sink)) == want


def test_bitmaps_against_count_distinct(spark):
    facts = IO.stored(TB.keyword_facts(spark, SF_SMALL), "facts")
    ids, maps = {}, {}
    for c in ("video_id", "keyword"):
        values = facts.select(F.col(c).alias("value"))
        first = IO.stored(B.extended_ids(values.limit(40), buckets=7), "ids")
        ids[c] = IO.stored(B.extended_ids(values, first, buckets=7), "ids")
        assert ids[c].join(first, ["value", "id"]).count() == first.count()
        n = ids[c].agg(F.count_distinct("id"), F.count("id"), F.min("id")).first()
        assert n[0] == n[1] == facts.select(c).where(F.col(c).isNotNull()).distinct().count() and n[2] >= 1
        maps[c] = IO.stored(B.daily_bitmaps(facts, c, ids[c]), "maps")
        assert B.distinct_count(maps[c]).first()[0] == n[0]
    for as_of in (P.AS_OF, P.AS_OF - dt.timedelta(days=3, hours=5, minutes=7)):
        assert B.metrics(facts, maps, ids, as_of).collect() == G.metrics(facts, as_of).collect()
    empty = B.daily_bitmaps(facts.limit(0), "keyword", ids["keyword"])
    assert B.distinct_count(empty).first()[0] == 0
