"""The tasks that count tokens follow the characters of the texts, so that no task grows with the input."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kwpulse.operators import extract as X
from kwpulse.operators import language as LG
from kwpulse.operators import videos as V
from kwpulse.schemas import KW_COLUMNS, MODAL_TEXTS


def _texts(spark, n):
    rows = [(f"v{i}", "ocr", i, f"the alpha{i} beta beta gamma 2024 word{i % 7}") for i in range(n)]
    return X.with_frame_key(spark.createDataFrame([*rows, ("null", "ocr", 0, None)], MODAL_TEXTS))


def test_tasks_grow_with_the_characters_not_the_session(spark, monkeypatch):
    monkeypatch.setattr(X, "TASK_CHARS", 400, raising=False)
    monkeypatch.setattr(X, "FEW_CHARS", 100, raising=False)
    for n in (100, 400):
        chars = sum(len(r.text or "") for r in _texts(spark, n).collect())
        parts = X._clustered(_texts(spark, n), X.TEXT_KEYS).rdd.glom().map(
            lambda rows: sum(len(r.text or "") for r in rows)).collect()
        assert len(parts) == chars // 400 + 1 and sum(parts) == chars
        assert max(parts) < 400 * 5  # hashed: some hold several texts more than the mean


def test_results_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    texts = _texts(spark, 60)
    model = LG.fit(spark.createDataFrame([("the alpha beta", "en"), ("das ist nicht", "de")], "text string, lang string"))

    def results():
        frames = (X.keywords(texts, X.TEXT_KEYS, 3), X.token_freq(texts, X.TEXT_KEYS), X.text_languages(texts, X.TEXT_KEYS),
                  LG.languages(texts, X.TEXT_KEYS, model))
        return [sorted(map(repr, f.collect())) for f in frames]

    few = results()
    assert few[0] and len(few[2]) == len(few[3]) == 61
    monkeypatch.setattr(X, "TASK_CHARS", 50, raising=False)
    monkeypatch.setattr(X, "FEW_CHARS", 10, raising=False)
    assert X._tasks(texts) > 40
    assert results() == few


def test_no_texts(spark):
    none = X.with_frame_key(spark.createDataFrame([], MODAL_TEXTS))
    assert X.keywords(none, X.TEXT_KEYS).collect() == [] and X.text_languages(none, X.TEXT_KEYS).collect() == []


def test_entries_are_joined_once_a_text_not_once_a_keyword(spark):
    """The join back to the entries runs in the session's partitions: it moves a row a text, the keywords come out after it."""
    entries = [(1, "a", "alpha beta gamma delta delta"), (1, "b", "sigma omega"), (2, "", "2024 77"), (3, None, None), (None, "d", "kappa"),
               (4, "e", " ".join(f"w{i}" for i in range(50)))]
    missing = ("url", "caption", "region", "category", "createTime", "playAddr", "stats")
    raw = spark.createDataFrame(entries, "entry_id long, id string, desc string").selectExpr(
        "*", *[f"cast(null as string) as {c}" for c in missing],
        "named_struct('title', 'song', 'author', cast(null as string), 'authorName', cast(null as string)) as music",
        "cast(null as struct<id: string, playAddr: string, createTime: string>) as video",
        "cast(null as struct<uniqueId: string>) as author")
    facts = V.extract_keyword_facts(raw, dt.datetime(2024, 1, 31), 20)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(keywords") < plan.index("Join Inner, (entry_id")
    rows = X.keywords(X.with_frame_key(V.text_sources(raw)), ["entry_id", "modality", "frame_k"], 20).join(
        V.video_records(raw, dt.datetime(2024, 1, 31)), "entry_id").withColumn("confidence", F.lit(1.0)).select(*KW_COLUMNS)
    expected = sorted(map(repr, rows.collect()))
    assert sorted(map(repr, facts.collect())) == expected
    assert len(expected) == 2 * (4 + 2 + 1 + 1) + 3 + 20  # entry 1 stands twice: each row's texts meet both; songs; 20 of 50 words


def test_a_task_counts_four_million_characters_on_average(spark):
    texts = spark.range(80).select(F.repeat(F.lit("a"), 1 << 20).alias("text"))
    assert (80 << 20) / X._tasks(texts) <= 4 << 20


def test_corpus_stopwords_leave_the_words_in_the_partitions_they_were_counted_in(spark):
    rows = [("en", "the cat and the dog"), ("en", "the house"), ("en", "a tree"), ("de", "der Hund"), ("de", "der Baum"),
            (None, "the the"), ("fr", None), ("es", "2024 casa")]
    words = X.corpus_stopwords(spark.createDataFrame(rows, "lang string, text string"), 0.6)
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(lang#" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(lang#" in x and "word#" not in x]
    assert sorted(map(tuple, words.collect())) == [("de", "der"), ("en", "the"), ("es", "2024"), ("es", "casa")]


def test_many_languages_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(X, "MOST_LANGS", 2)
    rows = spark.createDataFrame([(f"l{i}", f"word{i} both") for i in range(5)], "lang string, text string")
    assert X.corpus_stopwords(rows, 0.5).count() == 10


def test_a_language_model_ranks_trigrams_in_buckets_first(spark, monkeypatch):
    """The task of a language sorts a bounded number of rows, and the model is that of one ranking."""
    frames = {}
    kept_stored = LG.stored
    monkeypatch.setattr(LG, "stored", lambda df, name: frames.setdefault(name, kept_stored(df, name)) if name == "language-grams"
                        else frames.update({name: df}) or df)
    rows = [(" ".join(f"{a}{b}{'xyz'[j % 3]}" for j, b in enumerate("abcdefghij")), lang) for a in "klmnopq" for lang in ("en", "de")]
    model = LG.fit(spark.createDataFrame([*rows, (None, "en"), ("abc", None)], "text string, lang string"), kept=7)
    listed = sorted((r.lang, r.gram) for r in model.where("gram IS NOT NULL").collect())
    counts = {}
    for r in frames["language-grams"].collect():
        counts.setdefault(r.lang, []).append((-r.n, r.gram))
    assert min(map(len, counts.values())) > 7 * 3
    assert listed == sorted((lang, g) for lang, grams in counts.items() for _, g in sorted(grams)[:7])
    plan = frames["language-model"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "bucket" in plan
