"""Language of a text by a character n-gram model (X5, N6): fitted from labelled rows, applied by a join and sums.

The model is a table: for each language the ``KEPT`` most frequent trigrams of its words (a blank before and after each
word) with scaled integer log-probabilities, and one value for all other trigrams. A text's score of a language is the sum
over its trigrams; the best language wins, ties go to the first in the alphabet, a text without letters to ``en``. Words
longer than 32 letters are cut, so that taking trigrams stays linear.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.functions import dims
from kwpulse.operators.extract import MOST_LANGS, _clustered, _keys_of
from kwpulse.sources.files import stored

WORD = r"\p{L}{1,32}"
KEPT = 3000  # trigrams of a language
BUCKETS = 16  # in which a language's trigrams are ranked first
SCALE = 1000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _trigrams(word: str) -> Column:
    padded = F.concat(F.lit(" "), F.col(word), F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substr(padded, i, F.lit(3)))


def fit(labelled: DataFrame, kept: int = KEPT) -> DataFrame:
    """(text, lang) rows -> the model: ``lang, gram, score``; a null gram stands for all that are not listed.

    Words are counted per language before they are cut into trigrams, so both aggregates combine map-side; the table
    has at most ``kept`` + 1 rows a language. Null texts and labels take no part. Trigrams are ranked in buckets by hash and
    the first ``kept`` of each again, so that the task of a language sorts ``BUCKETS`` * ``kept`` rows at most."""
    words = (labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.explode(_words(F.col("text"))).alias("word"))
             .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    grams = stored(words.select("lang", F.explode(_trigrams("word")).alias("gram"), "n")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    total = grams.groupBy("lang").agg((F.sum("n") + kept).alias("total"))
    top = grams.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)))
    for by in (["lang", "bucket"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "gram"))
        top = top.withColumn("r", rank).where(F.col("r") <= kept).drop("r")
    score = lambda n: F.floor(SCALE * F.log((n + 1) / F.col("total"))).cast("long").alias("score")
    return stored(top.join(F.broadcast(total), "lang").select("lang", "gram", score(F.col("n"))).unionByName(
        total.select("lang", F.lit(None).cast("string").alias("gram"), score(F.lit(0)))), "language-model")


def languages(texts: DataFrame, keys: Sequence[str], model: DataFrame) -> DataFrame:
    """(keys..., lang) of every row of ``texts`` under a fitted model; one shuffle, of the texts.

    The model's bound is fixed (``KEPT`` a language, at most ``MOST_LANGS`` languages, checked), so it is broadcast, one row a
    trigram with a column for each language."""
    others = {r["lang"]: r["score"] for r in model.where("gram IS NULL").limit(MOST_LANGS + 1).collect()}
    if len(others) > MOST_LANGS:
        raise ValueError(f"a model has at most {MOST_LANGS} languages")
    langs = sorted(others)
    if not langs:
        return texts.select(*keys, F.lit(dims.DEFAULT_LANG).alias("lang"))
    wide = model.where("gram IS NOT NULL").groupBy("gram").agg(
        *[F.max(F.when(F.col("lang") == x, F.col("score"))).alias(f"s{i}") for i, x in enumerate(langs)])
    words = (_clustered(texts, keys).select("_tid", F.explode_outer(_words(F.col("text"))).alias("word"))
             .groupBy("_tid", "word").agg(F.count(F.lit(1)).alias("n")))
    grams = words.select("_tid", "n", F.explode_outer(_trigrams("word")).alias("gram"))
    sums = grams.join(F.broadcast(wide), "gram", "left").groupBy("_tid").agg(
        F.count("gram").alias("grams"),
        *[F.sum(F.col("n") * F.coalesce(f"s{i}", F.lit(others[x]))).alias(f"t{i}") for i, x in enumerate(langs)])
    pick = lambda a, b: F.when(b["s"] > a["s"], b).otherwise(a)
    best = reduce(pick, [F.struct(F.col(f"t{i}").alias("s"), F.lit(x).alias("lang")) for i, x in enumerate(langs)])
    return sums.select(*_keys_of(keys), F.when(F.col("grams") > 0, best["lang"]).otherwise(F.lit(dims.DEFAULT_LANG)).alias("lang"))
