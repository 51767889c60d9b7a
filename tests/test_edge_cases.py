"""Hand-made edge rows for each quirk of the reference (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import kw_rows, ts
from kwpulse.operators import clean as C
from kwpulse.operators import extract as X
from kwpulse.operators import filters as FL
from kwpulse.operators import growth as G
from kwpulse.operators import reports as R
from kwpulse.operators import videos as V
from kwpulse.schemas import MODAL_TEXTS, VIDEO
from kwpulse.sources import files as IO

AS_OF = dt.datetime(2024, 1, 31)


def test_rates_zero_when_no_plays(spark):
    df = kw_rows(spark, [dict(stats='{"diggCount":5,"shareCount":2,"playCount":0}'),
                         dict(stats='{"diggCount":5,"shareCount":2}')])
    out = C.clean(df).select("engagement_total", "engagement_rate", "virality_index",
                             "discussion_rate", "save_rate").collect()
    assert [tuple(r) for r in out] == [(7, 0.0, 0.0, 0.0, 0.0)] * 2


def test_stats_variants_clean_and_growth(spark):
    variants = [None, "not json", "{}", '{"diggCount":"12","commentCount":"1","shareCount":"1",'
                                        '"playCount":"12"}']
    df = kw_rows(spark, [dict(video_id=str(i), stats=s) for i, s in enumerate(variants)])
    got = {r.video_id: r.diggCount for r in C.clean(df).collect()}
    assert got == {"0": 0, "1": 0, "2": 0, "3": 12}
    kept = [r.video_id for r in FL.engagement_filter(df).collect()]
    assert kept == ["3"]  # missing keys fail even zero minimums


def test_growth_case_values(spark):
    cur, prev = ts("2024-01-30 12:00:00"), ts("2024-01-29 12:00:00")
    rows = []
    for kwd, (c, p) in {"a": (2, 0), "b": (1, 0), "c": (3, 2), "d": (1, 2)}.items():
        rows += [dict(keyword=kwd, detected_at=cur)] * c + [dict(keyword=kwd, detected_at=prev)] * p
    out = G.growth(kw_rows(spark, rows), AS_OF, "daily", growth_threshold=-10, limit=None)
    got = {r.keyword: r.growth_rate for r in out.collect()}
    assert got == {"a": 999.0, "b": 0.0, "c": 0.5, "d": -0.5}


def test_window_edges(spark):
    rows = [dict(keyword="at_start", detected_at=AS_OF - dt.timedelta(days=1)),
            dict(keyword="at_end", detected_at=AS_OF)]
    out = G.growth(kw_rows(spark, rows), AS_OF, "daily", growth_threshold=-1, limit=None)
    assert [r.keyword for r in out.collect()] == ["at_start"]


def test_null_key_never_matches_previous(spark):
    cur, prev = ts("2024-01-30 12:00:00"), ts("2024-01-29 12:00:00")
    rows = [dict(category=None, detected_at=cur)] * 2 + [dict(category=None, detected_at=prev)] * 2
    out = G.growth(kw_rows(spark, rows), AS_OF, "daily", growth_threshold=0, limit=None).collect()
    assert [(r.current_mentions, r.prev_mentions, r.growth_rate) for r in out] == [(2.0, 0.0, 999.0)]


def test_hourly_threshold_half_fixture(spark):
    rows = ([dict(keyword="up", detected_at=ts("2024-01-30 23:30:00"))] * 3
            + [dict(keyword="up", detected_at=ts("2024-01-30 22:10:00"))] * 2
            + [dict(keyword="flat", detected_at=ts("2024-01-30 23:01:00")),
               dict(keyword="flat", detected_at=ts("2024-01-30 22:01:00"))])
    out = G.growth(kw_rows(spark, rows), AS_OF, "hourly", growth_threshold=0.5).collect()
    assert [(r.keyword, r.growth_rate) for r in out] == [("up", 0.5)]


def test_invalid_window_name(spark):
    with pytest.raises(ValueError):
        G.growth(kw_rows(spark, [{}]), AS_OF, "monthly")


def test_backtest_omits_late_keywords(spark):
    rows = [dict(keyword="old", detected_at=ts("2024-01-20 00:00:00")),
            dict(keyword="old", detected_at=ts("2024-01-25 00:00:00")),
            dict(keyword="late", detected_at=ts("2024-01-26 00:00:00"))]
    out = G.backtest(kw_rows(spark, rows), AS_OF, 7, 3).collect()
    assert [(r.keyword, r.count_then, r.count_future, r.growth) for r in out] == [("old", 1, 2, 1.0)]


def _texts(spark, rows):
    return spark.createDataFrame([(v, m, f, t) for v, m, f, t in rows], MODAL_TEXTS)


def test_ties_keep_first_occurrence(spark):
    t = _texts(spark, [("1", "caption", None, "zeta alpha zeta alpha beta gamma")])
    out = X.modal_keywords(t).orderBy("rank").collect()
    assert [r.keyword for r in out] == ["zeta", "alpha", "beta", "gamma"]


def test_token_rules(spark):
    t = _texts(spark, [("1", "ocr", 3, "42 x a×b l’été it's The the")])
    out = X.modal_keywords(t).orderBy("rank").collect()
    assert [r.keyword for r in out] == ["été", "it's"]  # 'the' is an English stopword
    assert {r.frame for r in out} == {3}


def test_language_detection_and_default(spark):
    t = _texts(spark, [("1", "caption", None, "der Hund und die Katze"),
                       ("2", "caption", None, "le chat et la souris"),
                       ("3", "caption", None, "zzz qqq")])
    got = {r.video_id: r.lang for r in X.text_languages(X.with_frame_key(t), X.TEXT_KEYS).collect()}
    assert got == {"1": "de", "2": "fr", "3": "en"}


def _videos(spark, records):
    rows = []
    for r in records:
        rows.append(Row(**{f.name: r.get(f.name) for f in VIDEO.fields}))
    return spark.createDataFrame(rows, VIDEO).withColumn("entry_id", F.monotonically_increasing_id())


def test_posted_at_rules(spark):
    vids = _videos(spark, [dict(id="a", createTime=None), dict(id="b", createTime="0"),
                           dict(id="c", createTime="abc"), dict(id="d", createTime="1704067200")])
    got = {r.video_id: r.posted_at for r in V.video_records(vids, AS_OF).collect()}
    assert got == {"a": AS_OF, "b": AS_OF, "c": AS_OF, "d": dt.datetime(2024, 1, 1)}


def test_video_id_fallbacks(spark):
    vids = _videos(spark, [dict(id="", video=Row(id="inner", playAddr=None, createTime=None)),
                           dict(id="", video=Row(id="", playAddr=None, createTime=None))])
    assert sorted(r.video_id for r in V.video_records(vids, AS_OF).collect()) == ["inner", "unknown"]


def test_music_text_and_sources(spark):
    vids = _videos(spark, [dict(id="a", desc="", caption="hello world",
                                music=Row(title="Song", author="Band", authorName=None)),
                           dict(id="b", music=Row(title=" ", author=None, authorName=None))])
    got = sorted((r.entry_id, r.modality, r.text) for r in V.text_sources(vids).collect())
    assert [(m, t) for _, m, t in got] == [("caption", "hello world"), ("music", "Song Band")]


def test_region_normalisation_and_iso(spark):
    df = C.clean(kw_rows(spark, [dict(region=" us "), dict(region=None), dict(region="UK")]))
    got = sorted((r.region, r.iso3) for r in C.dashboard_frame(df).collect())
    assert got == [("UK", None), ("UNKNOWN", None), ("US", "USA")]


def test_dominant_modality_tie(spark):
    df = C.clean(kw_rows(spark, [dict(modality="music"), dict(modality="caption")]))
    out = R.top_keywords_modality(df).collect()
    assert [(r.keyword, r.modality) for r in out] == [("k", "caption")]


def test_quarantine_split(spark, tmp_path):
    p = tmp_path / "videos.json"
    p.write_text('{"id": "ok1", "desc": "fine"}\n{"id": "bad", "desc": \n{"id": "ok2"}\n')
    good, bad = IO.split_quarantine(IO.read_videos(spark, str(p), multiline=False))
    assert sorted(r.id for r in good.collect()) == ["ok1", "ok2"]
    assert bad.count() == 1


def test_json_array_file(spark, tmp_path):
    p = tmp_path / "arr.json"
    p.write_text('[{"id": "1", "desc": "Hello World", "stats": {"playCount": 7}},\n'
                 ' {"id": "2", "music": {"title": "T", "authorName": "A"}}]')
    good, _ = IO.split_quarantine(IO.read_videos(spark, str(p), multiline=True))
    recs = {r.video_id: r.stats for r in V.video_records(V.ensure_entry_id(good), AS_OF).collect()}
    assert recs["2"] == "{}" and '"playCount":7' in recs["1"]


def test_dashboard_backfills_missing_numeric_columns(spark):
    out = C.dashboard_frame(kw_rows(spark, [{}]).drop("stats")).first()
    assert out.playCount == 0 and out.engagement_rate == 0 and out.region == "US"


def test_unparsable_timestamp_becomes_null(spark, tmp_path):
    p = tmp_path / "kw.csv"
    p.write_text("video_id,keyword,modality,confidence,detected_at,posted_at,region,category,stats_json\n"
                 "1,k,caption,1.0,2024-01-02 03:04:05.000006,garbage,US,music,\"{\"\"playCount\"\": 3}\"\n")
    r = IO.read_keywords_csv(spark, str(p)).first()
    assert r.posted_at is None and r.detected_at == dt.datetime(2024, 1, 2, 3, 4, 5, 6)
    assert r.stats_json == '{"playCount": 3}'


def test_csv_timestamp_spellings(spark, tmp_path):
    p = tmp_path / "kw.csv"
    head = "video_id,keyword,modality,confidence,detected_at,posted_at,region,category,stats_json\n"
    p.write_text(head + "1,k,caption,1.0,2025-11-09 12:34:56.123456+00:00,2024-01-01 00:00:00,US,m,{}\n"
                 "2,k,caption,1.0,2025-11-09 12:34:56+02:00,nan,US,m,{}\n")
    got = [(r.detected_at, r.posted_at) for r in IO.read_keywords_csv(spark, str(p)).orderBy("video_id").collect()]
    assert got == [(dt.datetime(2025, 11, 9, 12, 34, 56, 123456), dt.datetime(2024, 1, 1)),
                   (dt.datetime(2025, 11, 9, 10, 34, 56), None)]


def test_all_countries_and_digit_only_texts(spark):
    df = C.clean(kw_rows(spark, [dict(region=c) for c in ("SE", "PL", "MX", "KR", "XX")]))
    assert {(r.region, r.iso3) for r in C.dashboard_frame(df).collect()} == {
        ("SE", "SWE"), ("PL", "POL"), ("MX", "MEX"), ("KR", "KOR"), ("XX", None)}
    texts = X.with_frame_key(spark.createDataFrame([("v", "ocr", 1, "2024 42"), ("w", "ocr", 1, "das ist nicht")], MODAL_TEXTS))
    assert sorted((r.video_id, r.lang) for r in X.text_languages(texts, X.TEXT_KEYS).collect()) == [("v", "en"), ("w", "de")]


def test_insert_defaults(spark):
    df = kw_rows(spark, [dict(posted_at=None)])
    out = IO.with_defaults(df, AS_OF, columns=("posted_at",)).first()
    assert out.posted_at == AS_OF


def test_demo_limit_keeps_first_entries(spark):
    vids = _videos(spark, [dict(id=str(i), desc=f"word{i} text") for i in range(5)])
    assert [r.id for r in V.first_entries(vids, 2).collect()] == ["0", "1"]


def test_repeated_text_rows_are_separate_texts(spark):
    """Rows that repeat their keys (appended copies) are separate texts, one
    keyword set each, never merged into one group."""
    rows = [("v1", "ocr", 3, "alpha beta beta")] * 3 + [("v2", "caption", None, "gamma")]
    texts = spark.createDataFrame(rows, MODAL_TEXTS)
    out = sorted((r.video_id, r.keyword, r.rank) for r in X.modal_keywords(texts, 20).collect())
    assert out == [("v1", "alpha", 2)] * 3 + [("v1", "beta", 1)] * 3 + [("v2", "gamma", 1)]
    freq = X.token_freq(X.with_frame_key(texts), X.TEXT_KEYS).filter("token = 'beta'").collect()
    assert [r.freq for r in freq] == [2, 2, 2]


def test_append_metadata_keeps_duplicates_and_skips_corrupt_old_file(spark, tmp_path):
    """Old + new records, duplicates kept; a corrupt old file adds no good record."""
    folder = str(tmp_path / "videos")
    batch = _videos(spark, [dict(id="1", desc="alpha"), dict(id="2", desc="beta")]).drop("entry_id")
    IO.append_videos(batch, folder)
    IO.append_videos(batch, folder)  # the same records again: kept twice
    (tmp_path / "videos" / "old-corrupt.json").write_text('{"id": "9", "desc": ')
    good, bad = IO.split_quarantine(IO.read_videos(spark, folder, multiline=False))
    assert sorted(r.id for r in good.collect()) == ["1", "1", "2", "2"]
    assert bad.count() == 1


def test_languages_of_the_collector_regions(spark):
    rows = [("it", "questo non è il gatto della nonna"), ("nl", "het is niet de kat van mijn oma"),
            ("pt", "isso não é o gato da minha avó"), ("digits", "2024 42")]
    df = spark.createDataFrame(rows, "video_id string, text string")
    got = {r.video_id: r.lang for r in X.text_languages(df, ["video_id"]).collect()}
    assert got == {"it": "it", "nl": "nl", "pt": "pt", "digits": "en"}
