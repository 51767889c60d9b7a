"""Personal data: base patterns, and contexts bootstrapped from them. DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.llm.common import written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3  # of scoring patterns and instances by each other
MIN_SUPPORT = 3  # distinct instances behind a pattern
ACCEPT = 0.9  # score from which a candidate is taken as an instance
CONTEXT = 64  # characters before a match that give its words

# The base patterns, possessive where no shorter match could succeed, and tried only where a run of their
# first class begins (or the last match ended), so that long runs cost linear time.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "candidate": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
    "digits": r"\(?+[0-9](?:[\x20().-]{0,3}+[0-9])*+",
}
CANDIDATES = ("candidate", "digits")
# what a text holds if the pattern can match at all
_GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "candidate": "[0-9@]", "digits": "[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(total, i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def valid(kind: Column, text: Column) -> Column:
    """Whether a match of a base pattern stands."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "ip", F.regexp_like(text, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")))
            .when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15)).when(kind == "email", True).otherwise(False))


def _matches(text: Column, kind: str) -> Column:
    """An array of (kind, gap, text, left): the matches with the number of characters since the last one
    and the last two words before them."""
    pattern = _PATTERNS[kind]
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                         F.split(text, pattern, -1).alias("g"))
    found = F.transform(F.filter(pairs, lambda x: x["m"].isNotNull()), lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["g"]).alias("gap"), x["m"].alias("text"),
        F.lower(F.substring(x["g"], -CONTEXT, CONTEXT)).alias("left")))
    none = F.filter(F.array(F.struct(F.lit(kind).alias("kind"), F.lit(0).alias("gap"), F.lit("").alias("text"),
                                     F.lit("").alias("left"))), lambda x: F.lit(False))
    return F.when(F.regexp_like(text, F.lit(_GUARDS[kind])), found).otherwise(none)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
         accept: float = ACCEPT) -> DataFrame:
    """One row per input row: id; ``base`` and ``added``, arrays of (kind, start, end, text) sorted by kind
    (email, ip, card, phone) and start. Offsets count code points, the end is exclusive.

    Base spans: leftmost non-overlapping matches of each kind's pattern in the whole text, less those
    that fail the kind's check (parts of an IP address at most 255, 16 to 19 digits that pass Luhn, 8
    to 15 digits of a phone number). Added spans: base spans are the seeds; the one and two words to the left of a
    seed are patterns of its kind; candidates are identifier-like tokens (without white space, at most 64
    characters, six digits or an ``@``) and runs of 6 to 19 digits with blanks, brackets, dots or hyphens, three at most, between
    them; neither overlaps a base span. Each round sets a pattern's
    confidence to the summed scores of its instances over all its occurrences plus two, if at least
    ``MIN_SUPPORT`` distinct instances stand behind it, and an instance's score of a kind to the
    noisy-or of its patterns; seeds keep 1. Candidates that reach ``accept`` are added, as the kind of
    their highest score (ties: the kind listed first); of an accepted run and tokens that overlap it the run stays.

    Null texts count as empty and give empty arrays. Other columns are not read, repeated rows are
    searched each. The texts are read once and not shuffled; matches, without their texts, go through the
    shared folder, and the graph is aggregated map-side, so frequent contexts are summed before
    they meet. One document's spans are kept together, those of different documents never.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        F.concat(*[_matches(text, k) for k in _PATTERNS]).alias("found"))
    found = written(found, "pii-matches")

    w = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = found.select("row", F.posexplode("found").alias("at", "f")).select(
        "row", "at", "f.kind", "f.gap", "f.text", "f.left")
    spans = spans.withColumn("end", F.sum(F.col("gap") + F.length("text")).over(w).cast("long"))
    spans = spans.withColumn("start", F.col("end") - F.length("text"))
    digits = F.length(F.regexp_replace("text", "[^0-9]", ""))
    like = ((F.col("kind") == "candidate") & (F.length("text") <= 64) & ((digits >= 6) | F.contains("text", F.lit("@")))) | (
        # a run without a blank or bracket stands in a token
        (F.col("kind") == "digits") & digits.between(6, 19) & F.regexp_like("text", F.lit(r"[\x20()]")))
    spans = spans.where(like | valid(F.col("kind"), F.col("text")))
    one = F.regexp_extract("left", r"(\S+)\s+$", 1)
    two = F.regexp_extract("left", r"(\S+\s+\S+)\s+$", 1)
    spans = written(spans.select("row", "kind", "start", "end", "text", one.alias("one"), two.alias("two")), "pii-spans")

    order = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    base = spans.where(~F.col("kind").isin(*CANDIDATES))
    in_row = F.sort_array(F.collect_list(F.struct(order.alias("o"), "start", "end", "kind", "text")))
    base_rows = base.groupBy("row").agg(in_row.alias("base"))

    def clear_of(df, others, name):  # the spans that overlap none of their row's others
        over = F.exists(name, lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
        return df.join(others, "row", "left").where(~F.coalesce(over, F.lit(False))).drop(name)

    free = clear_of(spans.where(F.col("kind").isin(*CANDIDATES)), base_rows, "base").withColumnRenamed("kind", "shape")
    added = written(_bootstrap(base, free, rounds, accept), "pii-added")
    runs = added.where("shape = 'digits'")
    tokens = clear_of(added.where("shape = 'candidate'"), runs.groupBy("row").agg(in_row.alias("runs")), "runs")
    added = runs.unionByName(tokens)
    added_rows = added.groupBy("row").agg(in_row.alias("added"))
    plain = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"))).alias(c)
    none = F.from_json(F.lit("[]"), "array<struct<o:int,start:long,end:long,kind:string,text:string>>")
    return (found.select("row", "id").join(base_rows, "row", "left").join(added_rows, "row", "left")
            .withColumn("base", F.coalesce("base", none)).withColumn("added", F.coalesce("added", none))
            .select(F.col("id").alias(id_col), plain("base"), plain("added")))


def _bootstrap(base: DataFrame, free: DataFrame, rounds: int, accept: float) -> DataFrame:
    """The candidates that the pattern-instance graph accepts, with their kinds."""
    patterns = F.explode(F.filter(F.array(F.concat(F.lit("1 "), F.col("one")), F.concat(F.lit("2 "), F.col("two"))),
                                  lambda p: F.length(p) > 2)).alias("pattern")
    both = base.select("text", "one", "two", F.col("kind").alias("seed")).unionByName(
        free.select("text", "one", "two", F.lit(None).cast("string").alias("seed")))
    # the graph: how often an instance stands in a context, as seed of a kind or as a candidate
    graph = written(both.select("text", "seed", patterns).groupBy("pattern", "text", "seed")
                    .agg(F.count(F.lit(1)).alias("n")), "pii-graph")
    totals = graph.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = graph.where("seed IS NOT NULL").select("pattern", "text", F.col("seed").alias("kind"), "n", F.lit(1.0).alias("score"))
    open_ = graph.where("seed IS NULL").select("pattern", "text", "n")
    scores = None
    for _ in range(max(1, rounds)):
        known = seeds
        if scores is not None:
            known = seeds.unionByName(open_.join(scores, "text").select("pattern", "text", "kind", "n", "score"))
        confidence = (known.groupBy("pattern", "kind").agg(F.sum(F.col("score") * F.col("n")).alias("weight"),
                                                           F.sum(F.when(F.col("score") > 0.5, 1).otherwise(0)).alias("support"))
                      .where(F.col("support") >= MIN_SUPPORT).join(totals, "pattern")
                      .select("pattern", "kind", (F.col("weight") / (F.col("total") + 2)).alias("c")))
        miss = F.exp(F.sum(F.col("n") * F.log(F.greatest(F.lit(1e-9), 1 - F.col("c")))))
        scores = written(open_.join(confidence, "pattern").groupBy("text", "kind").agg((1 - miss).alias("score")), "pii-scores")
    best = scores.groupBy("text").agg(F.max(F.struct(
        "score", (-F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))).alias("o"), "kind")).alias("b"))
    best = best.where(F.col("b.score") >= accept).select("text", F.col("b.kind").alias("kind"))
    return free.join(best, "text")


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, all spans as text, and the numbers of added and of all spans."""
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    order = F.array(*[F.lit(k) for k in KINDS])
    both = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(
        F.array_position(order, x["kind"]).alias("o"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in KINDS]
    return found.select(id_col, *counts, F.sha2(text("base"), 256).alias("base_sha256"), text(both).alias("spans"),
                        F.size("added").cast("long").alias("n_added"), F.size(F.concat("base", "added")).cast("long").alias("n_spans"))
