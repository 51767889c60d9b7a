"""The scheduled chain end to end on metadata written as a JSON file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from kwpulse.operators import clean as C
from kwpulse.operators import growth as G
from kwpulse.operators import videos as V
from kwpulse.plans import jobs as J
from kwpulse.plans import params as P
from kwpulse.session import scratch_path
from kwpulse.sources import files as IO
from kwpulse.sources import tables as TB


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_run_all(spark):
    payloads = TB.video_payloads(spark, SF_SMALL)
    src = scratch_path(spark, "videos-json")
    # JSON lines: every record, plus one malformed line
    payloads.drop("entry_id").write.json(src)
    spark.createDataFrame([('{"id": "broken", ',)], "value string").write.mode("append").text(src)
    out = J.run_all(spark, src, scratch_path(spark, "run"), P.AS_OF,
                    growth_params=dict(time_window="weekly", growth_threshold=0.0, limit=None),
                    multiline=False)

    facts = IO.read_facts(spark, out["facts"]).drop("detected_date")
    expected = V.extract_keyword_facts(payloads, P.AS_OF)
    assert _rows(facts) == _rows(expected)
    assert spark.read.json(out["quarantine"]).count() == 1
    assert spark.read.parquet(out["clean"]).count() == facts.count()
    csv = IO.csv_as_facts(IO.read_keywords_csv(spark, out["keywords_csv"]))
    assert _rows(csv) == _rows(facts)
    rollup = spark.read.parquet(out["rollup"]).agg(F.sum("mentions")).first()[0]
    assert rollup == facts.count()
    trending = spark.read.parquet(out["trending"])
    direct = G.growth(facts, P.AS_OF + dt.timedelta(microseconds=1), "weekly", 0.0, limit=None)
    assert 0 < trending.count() == direct.count()
    assert [r.metric_name for r in spark.read.parquet(out["metrics"]).collect()] == G.METRIC_NAMES


def test_scheduled_growth_sees_the_run_and_its_texts(spark):
    """The scheduler's own parameters: five records over the minimums, and texts by video id."""
    stats = '{"diggCount": "60", "commentCount": 6.0, "shareCount": 3, "playCount": 2000, "other": 1}'
    src = scratch_path(spark, "videos-array")
    body = ", ".join('{"id": "v%d", "desc": "wonder rocket", "region": "US", "stats": %s}' % (i, s) for i, s in
                     enumerate([stats.replace('"60"', "60").replace("6.0", "6")] * 5 + [stats]))
    spark.createDataFrame([("[" + body + ', "no record", {"id": "w", "music": 3}]',)], "value string").coalesce(1).write.text(src)
    texts = spark.createDataFrame([("v0", "ocr", 1, "banner"), ("v1", "transcript", None, "banner"), ("zz", "ocr", 1, "lost")],
                                  "video_id string, modality string, frame long, text string")
    out = J.run_all(spark, src, scratch_path(spark, "run"), P.AS_OF, multiline=True, texts=texts)
    rows = {(r.keyword, r.mentions, r.growth_rate) for r in spark.read.parquet(out["trending"]).collect()}
    assert {("wonder", 5, 999.0), ("rocket", 5, 999.0), ("banner", 2, 999.0)} <= rows and len(rows) == 3
    bad = spark.read.option("columnNameOfCorruptRecord", "x").json(out["quarantine"])
    assert bad.count() == 2 and max(len(r._corrupt_record) for r in bad.collect()) < 40
    clean = spark.read.parquet(out["clean"])
    assert {(r.diggCount, r.commentCount) for r in clean.filter("video_id = 'v5'").collect()} == {(60, 6)}
    assert all('"other":1' in r.stats for r in clean.collect())


def test_extract_runs_append_facts_and_csv(spark):
    """Two scheduled runs: each appends its own rows to the facts and to the CSV."""
    payloads = TB.video_payloads(spark, SF_SMALL).limit(40)
    src = scratch_path(spark, "videos-json")
    payloads.drop("entry_id").write.json(src)
    out = J.paths(scratch_path(spark, "runs"))
    for as_of in (P.AS_OF, P.AS_OF + dt.timedelta(hours=1)):
        J.extract_job(spark, IO.read_videos(spark, src, multiline=False), out, as_of)
    facts = IO.read_facts(spark, out["facts"]).drop("detected_date")
    csv = IO.csv_as_facts(IO.read_keywords_csv(spark, out["keywords_csv"]))
    assert facts.select("detected_at").distinct().count() == 2
    assert _rows(csv) == _rows(facts)
    J.clean_job(spark, out, P.AS_OF)
    J.clean_job(spark, out, P.AS_OF)  # a rerun replaces its date partition
    clean = spark.read.parquet(out["clean"]).drop("detected_date")
    assert _rows(clean) == _rows(C.clean(facts))
