"""Keyword extraction (X3/X4/X5, P8, A14, W2, F15, F16, J7) with built-ins only.

Plan for a table of texts keyed by ``keys`` (ONE shuffle, of text rows):

0. ``repartition(n, struct(keys))``                      the only shuffle; n by
   the counted characters of the texts
1. ``posexplode(regexp_extract_all(lower(text)))``, digit-only tokens dropped
2. ``groupBy(keys, token) -> freq, first_pos``           no exchange: the
   partitioning on keys already clusters every (keys, token) group
3. broadcast left join with the stopword table (one row per word, with the
   languages it belongs to); per text, stopword hits per language are window
   sums over the whole text                              no exchange
4. the text's language = most hits (ties: language code; none: ``en``); tokens
   that are stopwords of that language are dropped
5. top-k by ``row_number`` over (freq desc, first_pos)   no exchange, and no
   second sort: steps 3 and 5 share the window order

A text is one row (its own id even when rows repeat their keys), so a group is
bounded by one text's length; nothing is collected. Ties keep first-occurrence order (the reference's stable sort over
an insertion-ordered dict). Dropping tokens before counting does not change the
first-occurrence order of the tokens that remain.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kwpulse.functions import dims
from kwpulse.functions.exprs import DIGITS_ONLY, TOKEN_PATTERN
from kwpulse.sources.files import stored

TEXT_KEYS = ["video_id", "modality", "frame_k"]
STOPWORD_BROADCAST = 200_000  # words up to which a caller's stopword table is broadcast
MOST_LANGS = 200
TASK_CHARS = 4 << 20  # characters of text that a task counts at most on average: its hash tables and sort grow with them
FEW_CHARS = 1 << 20  # texts are not spread over more tasks than these allow
MOST_TASKS = 50_000  # of a shuffle; beyond 400 G characters the tasks grow and spill
LANE, LANES = 31, 2  # bits of a packed counter, counters in a long


def corpus_stopwords(texts: DataFrame, share: float = 0.3) -> DataFrame:
    """A stopword table (lang, word) from labelled texts (lang, text): the tokens that stand in at least ``share`` of
    a language's texts. One shuffle of the texts' distinct tokens, pre-aggregated: the words stay in its partitions, since
    the languages are broadcast if they are counted to be few. Joined by a shuffle, a language's words would be one task's."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN_PATTERN), F.lit(0)))
    rows = texts.where("lang IS NOT NULL AND text IS NOT NULL")
    per = rows.select("lang", F.explode(tokens).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    all_ = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")), "language-texts")
    if all_.limit(MOST_LANGS + 1).count() <= MOST_LANGS:
        all_ = F.broadcast(all_)
    return per.join(all_, "lang").where(F.col("n") >= share * F.col("texts")).select("lang", "word")


def with_frame_key(texts: DataFrame) -> DataFrame:
    """Join keys must be non-NULL: a missing frame becomes -1 internally."""
    return texts.withColumn("frame_k", F.coalesce(F.col("frame").cast("bigint"), F.lit(-1).cast("bigint")))


def _clustered(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Texts with one id column ``_tid = struct(keys, _row)``, hash-partitioned by it.

    ``_row`` gives every input row its own id, so each row is one text even when
    rows repeat their keys (appended metadata keeps duplicates) and copies of one
    text spread over tasks instead of forming one hot group. The id is fixed by
    the scan's split and row order, so a recomputed task reproduces it. One
    attribute as the key keeps every later grouping and window satisfied by this
    single partitioning, even when some key columns are constants that Catalyst
    would fold out of a multi-column key.

    The number of partitions follows the counted characters, so a task's memory does not grow
    with the input. Left to the session it would: a fixed number of partitions, coalesced further by
    the bytes of the compressed texts, of which tokens with their ids take many times the space.
    """
    tid = F.struct(*keys, F.monotonically_increasing_id().alias("_row"))
    return texts.withColumn("_tid", tid).repartition(_tasks(texts), "_tid")


def _tasks(texts: DataFrame) -> int:
    """Tasks for the texts, by their characters; costs a pass over the text column."""
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    share = chars // texts.sparkSession.sparkContext.defaultParallelism
    return min(MOST_TASKS, chars // min(TASK_CHARS, max(FEW_CHARS, share)) + 1)


def _keys_of(keys: Sequence[str]) -> list:
    return [F.col(f"_tid.{k}").alias(k) for k in keys]


def _tokens(texts: DataFrame, outer: bool = False) -> DataFrame:
    """(_tid, pos, token) for every non-numeric token; ``outer`` keeps token-less texts."""
    gen = F.posexplode_outer if outer else F.posexplode
    found = F.regexp_extract_all(F.lower(F.col("text")), F.lit(TOKEN_PATTERN), F.lit(0))
    if outer:  # digit-only tokens go before the rows are made, so that a text of them alone stays
        found = F.filter(found, lambda x: ~x.rlike(DIGITS_ONLY))
    t = texts.select("_tid", gen(found).alias("pos", "token"))
    return t if outer else t.filter(~F.col("token").rlike(DIGITS_ONLY))


def _freq(toks: DataFrame) -> DataFrame:
    return (toks.groupBy("_tid", "token")
            .agg(F.count(F.lit(1)).alias("freq"), (F.min("pos") + 1).alias("first_pos")))


def token_freq(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., token, freq, first_pos) of non-numeric tokens, 1-based first position."""
    return _freq(_tokens(_clustered(texts, keys))).select(*_keys_of(keys), "token", "freq", "first_pos")


def stopword_table(spark: SparkSession, stopwords: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """((word, sw_langs, units...), the languages): the built-in lists, or the caller's table (lang, word).

    A caller's table is written once as one row per word and joined by broadcast if it is counted to be small,
    else by a shuffle of the tokens. Its languages become columns of the plan; their number is checked."""
    if stopwords is None:
        return F.broadcast(dims.stopword_langs_df(spark).select("word", "sw_langs", *_packed_units(dims.LANGS))), dims.LANGS
    rows = stopwords.select(F.lower("word").alias("word"), "lang").where("word IS NOT NULL AND lang IS NOT NULL")
    langs = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"a stopword table has at most {MOST_LANGS} languages")
    by_word = stored(rows.groupBy("word").agg(F.sort_array(F.collect_set("lang")).alias("sw_langs"))
                     .select("word", "sw_langs", *_packed_units(langs)), "stopwords")
    small = by_word.limit(STOPWORD_BROADCAST + 1).count() <= STOPWORD_BROADCAST
    return by_word.hint("broadcast" if small else "shuffle_merge"), langs


def _packed_units(langs: Sequence[str]) -> list[Column]:
    """Per word of a stopword table: its languages as ones in lanes of ``LANE`` bits, so that one sum counts the hits of
    several languages. A lane holds any text's hits: a string has fewer than 2^31 characters."""
    one = lambda lang, lane: F.when(F.array_contains("sw_langs", F.lit(lang)), F.lit(1 << (LANE * lane))).otherwise(F.lit(0))
    return [reduce(lambda x, y: x + y, [one(lang, j).cast("long") for j, lang in enumerate(langs[i:i + LANES])]).alias(f"units{i // LANES}")
            for i in range(0, len(langs), LANES)]


def _packed_hits(langs: Sequence[str]) -> list[Column]:
    """What to sum per text: the token's count in the lanes of the languages it is a stopword of."""
    return [F.coalesce(F.col(f"units{i}") * F.col("freq"), F.lit(0).cast("long")) for i in range(-(-len(langs) // LANES))]


def _unpacked(sums: Sequence[Column], langs: Sequence[str]) -> dict[str, Column]:
    return {lang: F.shiftright(sums[i // LANES], LANE * (i % LANES)).bitwiseAND(F.lit((1 << LANE) - 1)) for i, lang in enumerate(langs)}


def _best_lang(hits: dict[str, Column]) -> Column:
    """Language with most hits; ties -> alphabetically first; no hit -> default."""
    ranked = [F.struct(h.alias("h"), F.lit(-i).alias("o"), F.lit(lang).alias("lang"))
              for i, (lang, h) in enumerate(sorted(hits.items()))]
    if not ranked:
        return F.lit(dims.DEFAULT_LANG)
    best = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    return F.when(best["h"] > 0, best["lang"]).otherwise(F.lit(dims.DEFAULT_LANG))


def text_languages(texts: DataFrame, keys: Sequence[str], stopwords: DataFrame | None = None) -> DataFrame:
    """(keys..., lang) for every text (``en`` when no stopword matches); one shuffle.
    ``operators.language`` has a fitted model instead."""
    sw, langs = stopword_table(texts.sparkSession, stopwords)
    freq = _freq(_tokens(_clustered(texts, keys), outer=True))
    tagged = freq.join(sw, freq.token == sw.word, "left")
    per_text = tagged.groupBy("_tid").agg(F.count(F.lit(1)), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(_packed_hits(langs))])
    lang = _best_lang(_unpacked([F.col(f"h{i}") for i in range(-(-len(langs) // LANES))], langs))
    return per_text.select(*_keys_of(keys), lang.alias("lang"))


def keywords(texts: DataFrame, keys: Sequence[str], top_k: int = 20, stopwords: DataFrame | None = None) -> DataFrame:
    """(keys..., keyword, rank): the top-k non-stopword, non-numeric tokens of each text. ``stopwords`` (lang, word)
    takes the place of the built-in lists (``stopword_table``)."""
    return _ranked(texts, keys, top_k, stopwords).select(*_keys_of(keys), F.col("token").alias("keyword"), "rank")


def keyword_lists(texts: DataFrame, keys: Sequence[str], top_k: int = 20, stopwords: DataFrame | None = None) -> DataFrame:
    """(keys..., keywords): ``keywords`` as one row for each text that has any, for joins by a key: those move and sort a row a text
    instead of ``top_k``. Gathered inside the same partitioning; the list has no order."""
    lists = _ranked(texts, keys, top_k, stopwords).groupBy("_tid").agg(F.collect_list("token").alias("keywords"))
    return lists.select(*_keys_of(keys), "keywords")


def _ranked(texts: DataFrame, keys: Sequence[str], top_k: int, stopwords: DataFrame | None) -> DataFrame:
    """(_tid, token, rank) of the top-k tokens.

    The text rows are hash-partitioned once by their key; counting, language and
    top-k then all run inside that partitioning: one shuffle, of whole text rows,
    instead of shuffling (key, token) pairs twice (each pair repeats the key, so
    the pairs outweigh the text several times). Tokenising also gets the
    shuffle's parallelism rather than the scan's. A text is one row, so no group
    exceeds what one row holds.
    """
    sw, langs = stopword_table(texts.sparkSession, stopwords)
    freq = _freq(_tokens(_clustered(texts, keys)))
    tagged = freq.join(sw, freq.token == sw.word, "left")
    # Both windows share one order, so one per-partition sort serves them: the
    # language hits use the whole text as frame, the rank the running frame.
    ordered = Window.partitionBy("_tid").orderBy(F.desc("freq"), F.asc("first_pos"))
    whole_text = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = tagged.select("*", *[F.sum(h).over(whole_text).alias(f"_h{i}") for i, h in enumerate(_packed_hits(langs))])
    with_lang = summed.withColumn("lang", _best_lang(_unpacked([F.col(f"_h{i}") for i in range(-(-len(langs) // LANES))], langs)))
    is_sw = F.coalesce(F.array_contains(F.col("sw_langs"), F.col("lang")), F.lit(False))
    return (with_lang.filter(~is_sw)
                     .withColumn("rank", F.row_number().over(ordered))
                     .filter(F.col("rank") <= top_k)
                     .select("_tid", "token", "rank"))


def modal_keywords(texts: DataFrame, top_k: int = 20, stopwords: DataFrame | None = None) -> DataFrame:
    """Keyword rows of texts of any modality (one per keyword per frame)."""
    t = with_frame_key(texts)
    kws = keywords(t, TEXT_KEYS, top_k, stopwords)
    return kws.select("video_id", "modality",
                      F.when(F.col("frame_k") == -1, F.lit(None).cast("bigint"))
                       .otherwise(F.col("frame_k")).alias("frame"),
                      "keyword", "rank")
