"""Fuzzy line deduplication: SimHash blocks, pigeonhole segments, edit similarity, one line per group.

DataFrame operations only."""

from __future__ import annotations

import contextlib
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.llm.common import components, written

MIN_WORDS = 1  # lines of fewer words are always kept
SIMILARITY = 0.9
LANE = 22  # bits of a packed counter: three counters in a long, 22 longs for 64 bits
BLOCKS = ((0, 22), (22, 22), (44, 20))  # offset and width of the SimHash blocks
MAX_BITS = 10  # a crowded block's lines meet its leader anyway, others if their SimHashes differ in so many bits at most
SMALL = 48  # lines from which a block value is crowded
LEADER_ROUNDS = 2  # of the short cut; what it leaves open meets by segments
LEADER_KEYS = 4  # the keys of one range of positions in so many have a leader: a short cut again
LONG_WORD, WEIGHT = 5, 4  # words of so many letters count so many times: function words would crowd the blocks
CHUNK = 64  # characters cut at a time, so that cutting a long line stays linear
BROADCAST = 200_000  # rows, and for arrays also items
PART, JOBS = 3 << 19, 16  # characters of the lines whose segment keys meet in one task; jobs at most that such tasks are dealt to
VERIFY_PARTS = 16  # pairs meet their texts in so many parts at most
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SAME_PART = "spark.sql.requireAllClusterKeysForCoPartition"
EXCLUDED, COUNTED = "spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate"
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def normalised(text: Column) -> Column:
    """Lower case; every run of other characters than letters, digits and line feeds one blank."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def simhash(lines: DataFrame) -> DataFrame:
    """``id, line`` (one row per id) -> ``id, sim, size`` (characters): bit i is set if the words whose
    hashes have it weigh more than half. Each word adds its 64 hash bits, 3 to a long, to 22 sums, so that the work per word is a
    few dozen machine operations in one hash aggregate; lines beyond 250,000 words keep a defined
    but coarser value."""
    mask = reduce(lambda a, j: a | 1 << (LANE * j), range(3), 0)
    words = lines.select("id", F.length("line").alias("size"), F.explode(F.split("line", " ")).alias("w")).select(
        "id", "size", F.when(F.length("w") >= LONG_WORD, WEIGHT).otherwise(1).cast("long").alias("x"), F.xxhash64("w").alias("h"))
    sums = words.groupBy("id").agg(F.max("size").alias("size"), F.sum("x").alias("n"), *[
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(mask)) * F.col("x")).alias(f"s{i}") for i in range(LANE)])
    bits = []
    for i in range(64):
        width = LANE if i < 2 * LANE else 64 - 2 * LANE
        ones = F.shiftrightunsigned(f"s{i % LANE}", i // LANE * LANE).bitwiseAND(F.lit((1 << width) - 1))
        bits.append(F.when(ones * 2 > F.col("n"), F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select("id", "size", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("sim"))


@contextlib.contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    """Meanwhile the session has these settings."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _freed(spark: SparkSession):
    """Meanwhile the shuffle files of a job go when it ends, not when the driver happens to collect its garbage; rows that are dealt
    by one of the columns they are joined by are not shuffled once more; and what is exploded is not also counted beforehand."""
    rules = [x for x in (spark.conf.get(EXCLUDED, None) or "", COUNTED) if x]
    return _set(spark, {CLEANUP: "true", SAME_PART: "false", EXCLUDED: ",".join(rules)})


def _most(similarity: float, n: int) -> int:
    """The edits that ``similarity`` allows if the longer line has ``n`` characters."""
    return math.floor(round(1 - similarity, 6) * n + 1e-9)


def similar(a: str, b: str, similarity: float) -> Column:
    """Edit similarity of two columns, 1 - distance / longer length, reaches the bound. Near copies mostly have few edits,
    which a narrow band shows for a fraction of the work; the last band is that of the bound."""
    most = f"cast(floor({1 - similarity:.6f} * greatest(length({a}), length({b})) + 1e-9) as int)"
    bands = " OR ".join(f"levenshtein({a}, {b}, {x}) >= 0" for x in (f"cast({most} div 16 as int)", f"cast({most} div 4 as int)", most))
    return F.expr(f"abs(length({a}) - length({b})) <= {most} AND ({bands})")


def _few(df: DataFrame, items: Column | None = None) -> DataFrame:
    """Broadcast a written frame if it is small enough, by its count and by the sum of ``items``."""
    few = df.limit(BROADCAST + 1).count() <= BROADCAST
    if few and items is not None:
        few = (df.agg(F.sum(items)).first()[0] or 0) <= BROADCAST
    return F.broadcast(df) if few else df


def _lengths_fit(a: str, b: str, similarity: float) -> Column:
    """Lengths that edit similarity allows."""
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-6


def _leader_links(lines: DataFrame, texts_of, similarity: float) -> DataFrame:
    """``id, size, sim`` of the distinct lines -> verified links ``u, v`` of lines with the leader of a SimHash
    block. A short cut: it connects large groups of variants at a comparison for each; all it leaves
    open is found by ``_segment_pairs``."""
    block = F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("sim", o).bitwiseAND(F.lit((1 << w) - 1)).alias("value"))
                      for k, (o, w) in enumerate(BLOCKS)])
    rest = lines.select("id", "size", "sim", F.explode(block).alias("k")).select("k.block", "k.value", "id", "size", "sim")
    links = []
    for _ in range(LEADER_ROUNDS):
        leader = rest.groupBy("block", "value").agg(F.min(F.struct("id", "sim", "size")).alias("lead"), F.count(F.lit(1)).alias("n"))
        led = written(rest.join(leader.where("n > 1"), ["block", "value"]).select(
            "block", "value", "id", "size", "sim", "n", F.col("lead.id").alias("v"),
            (_lengths_fit("size", "lead.size", similarity) & ((F.col("n") > SMALL) | (
                F.bit_count(F.col("sim").bitwiseXOR(F.col("lead.sim"))) <= MAX_BITS))).alias("near")), "lines-led")
        found = _verified(led.where("near AND id <> v").select(F.col("id").alias("u"), "v").distinct(), texts_of, similarity)
        links.append(found)
        fits = found.select(F.col("u").alias("id"), "v")
        rest = led.where((F.col("n") > SMALL) & (F.col("id") != F.col("v"))).join(_few(fits), ["id", "v"], "left_anti").select(
            "block", "value", "id", "size", "sim")
        if rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, links)


def _class(similarity: float) -> tuple[Column, Column, int]:
    """The class of lengths of ``size``; how many characters a range of positions of the class ``cls`` has; and the number of
    ranges in a line. Two lengths that fit are of the same or of adjacent classes."""
    t, base = round(1 - similarity, 6), math.log(1.02 / similarity)
    return (F.floor(F.log(F.col("size")) / F.lit(base)).cast("int"), _reach(F.col("cls"), similarity), math.floor(1 / t) + 1)


def _reach(cls: Column, similarity: float) -> Column:
    """The characters of a range of positions of a class."""
    t, base = round(1 - similarity, 6), math.log(1.02 / similarity)
    return F.floor(F.exp((cls + 1) * F.lit(base)) * F.lit(t)).cast("int") + 1


def _classes(lines: DataFrame, similarity: float) -> list[tuple[int, int, int, int]]:
    """``size`` -> class, characters, least and greatest length of its lines."""
    rows = lines.groupBy(_class(similarity)[0].alias("cls")).agg(F.sum(F.col("size").cast("long")), F.min("size"), F.max("size"))
    return [tuple(r) for r in rows.orderBy("cls").collect()]


def _split(rows: list[tuple[int, int, int, int]], similarity: float, every: int = 1) -> list[tuple[int, int, int, int]]:
    """``_parts`` of the classes ``rows``."""
    ranges = _class(similarity)[2]
    part = PART * max(1, every // 2)
    starts, before = {}, 0
    for c, n, *_ in rows:
        for i in range(ranges):
            starts.setdefault(int((before + n * i / ranges) / part), c * ranges + i)
        before += n
    starts = list(starts.values())
    out = []
    for first, after in zip(starts, [*starts[1:], (rows[-1][0] + 1) * ranges if rows else 0]):
        held = [r for r in rows if first // ranges <= r[0] <= (after - 1) // ranges + 1]
        out.append((first, after - 1, held[0][2], held[-1][3]))
    return out


def _parts(lines: DataFrame, similarity: float, every: int = 1) -> list[tuple[int, int, int, int]]:
    """``size`` -> the parts in which the keys meet: first and last range of positions, counted through the classes, and
    least and greatest length of the lines with such keys. A key is of one range, so that each pair of rows meets in one part, and
    each part has about the same number of keys, whatever the lengths. ``every``: only one range in so many is used, and (from 2 on)
    a key of the longer line only in the range in which it begins."""
    return _split(_classes(lines, similarity), similarity, every)


def _chunks(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, size, group, line`` and maybe ``large`` -> a row for each CHUNK characters of a line from ``start`` on: ``text``,
    these and as many more as a key that begins in them takes; ``t`` edits are allowed if the line is the longer one."""
    t = round(1 - similarity, 6)
    extra = 4 * math.ceil(1 / t) + 4 if t else 4
    return lines.select("id", "size", "group", *(c for c in lines.columns if c == "large"), _class(similarity)[0].alias("own"),
                        F.floor(F.lit(t) * F.col("size") + 1e-9).cast("int").alias("t"), "line",
                        F.explode(F.expr(f"sequence(0, size - 1, {CHUNK})")).alias("start")).withColumn(
        "text", F.expr(f"substring(line, start + 1, {CHUNK} + {extra})")).drop("line")


def _apart(spark: SparkSession, n: int) -> list[int]:
    """``n`` integers that a hash partitioning in ``n`` deals to a partition each."""
    code = F.col("id").cast("int")
    seen = {r[0]: r[1] for r in spark.range(0, 24 * n, 1, 1).groupBy(F.pmod(F.hash(code), F.lit(n))).agg(F.min(code)).collect()}
    return [seen.get(i, i) for i in range(n)]


def _dealt(lines: DataFrame, similarity: float, parts: list[tuple[int, int, int, int]], every: int) -> DataFrame:
    """The chunks of the lines, once in the partition of each part in which one of their keys may meet another: ``code`` of the part,
    its ranges ``first`` to ``last`` and its share ``k`` of ``shares`` of the keys."""
    reach, ranges = _class(similarity)[1:]
    end = parts[-1][1] + 1
    first_of, last_of = [0] * end, [-1] * end  # of each range: the first part that ends there or later, the last that begins there or sooner
    done = 0
    for j, (first, last, *_) in enumerate(parts):
        for g in range(done, last + 1):
            first_of[g] = j
        done = max(done, last + 1)
        for g in range(first, end):
            last_of[g] = j

    def listed(values):
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")

    d = _chunks(lines, similarity).withColumn("cls", F.explode(F.array(F.col("own") - 1, F.col("own")))).withColumn("reach", reach)
    before, after = ("start - t", f"start + {CHUNK} + t div 2 + 1") if every == 1 else ("start", f"start + {CHUNK - 1}")
    low, high = f"greatest({before}, 0) div reach", f"least(({after}) div reach, {ranges - 1})"
    d = d.withColumn("lo", F.expr(f"cast({low} as int)")).withColumn("hi", F.expr(f"cast({high} as int)")).where(
        f"cls >= 0 AND hi div {every} * {every} >= lo")
    d = d.withColumn("from", F.get(listed(first_of), F.expr(f"cls * {ranges} + lo"))).withColumn(
        "to", F.get(listed(last_of), F.expr(f"least(cls * {ranges} + hi, {end - 1})"))).where("from <= to")
    d = d.select(*(c for c in d.columns if c not in ("lo", "hi", "reach", "from", "to")), F.explode(F.sequence("from", "to")).alias("j"))
    codes = _apart(lines.sparkSession, len(parts))
    for name, values in (("code", codes), ("first", [x[0] for x in parts]), ("last", [x[1] for x in parts]),
                         ("k", [x[2] for x in parts]), ("shares", [x[3] for x in parts])):
        d = d.withColumn(name, F.get(listed(values), "j"))
    return d.drop("j").repartition(len(parts), "code")


def _keys(chunks: DataFrame, similarity: float, every: int = 1) -> tuple[DataFrame, DataFrame]:
    """``_chunks`` with the class ``cls`` of the shorter line and ``code, first, last, k, shares`` -> the keys that they hold, see
    ``_segments``. All conditions name what the search for keys makes, so that none goes behind the exchange that both sides share;
    a key and the code of its part fit a long, the quicker kind of hash table."""
    t = round(1 - similarity, 6)
    width = [0] + [n // (_most(similarity, n) + 1) for n in range(1, 1 << 12)]
    short = max((n for n in range(1, 1 << 11) if width[n] != width[-1]), default=0)
    # the widths of lines that a line of m characters can be the shorter partner of
    widths = [sorted({width[n] for n in range(m, m + _most(similarity, 2 * m) + 2)
                      if 0 < _most(similarity, n) >= n - m}) for m in range(1, short + 1)]
    by_size = F.array(*[F.array(*[F.lit(x) for x in w]).cast("array<int>") for w in [*widths, [width[-1]]]])
    reach, ranges = _class(similarity)[1:]
    large = [c for c in chunks.columns if c == "large"]

    def of(at, length):  # characters of a chunk, at counted in the line
        return f"substring(text, {at} - start + 1, {length})"

    # lo and hi: the ranges of the part in the class
    chunks = chunks.withColumn("reach", reach).withColumn("lo", F.expr(f"greatest(first - cls * {ranges}, 0)")).withColumn(
        "hi", F.expr(f"least(last - cls * {ranges}, {ranges - 1})"))
    longer = chunks.withColumn("w", F.expr("cast(size div (t + 1) as int)"))
    i_from = "cast(ceil(cast(start as bigint) * (t + 1) / size) as int)"
    i_to = f"least(t, cast(ceil((start + {CHUNK}L) * (t + 1) / size) as int) - 1)"
    longer = longer.withColumn("i", F.explode(F.expr(f"CASE WHEN t > 0 AND {i_from} <= {i_to} THEN sequence({i_from}, {i_to}) END")))
    longer = longer.withColumn("p", F.expr("cast(cast(i as bigint) * size div (t + 1) as int)")).withColumn(
        "next", F.expr("cast((i + 1L) * size div (t + 1) as int)"))
    longer = longer.where("least((p + t div 2 + 1) div reach, hi) >= greatest(greatest(p - t, 0) div reach, lo)" if every == 1 else
                          f"p div reach % {every} = 0 AND p div reach BETWEEN lo AND hi")
    longer = longer.withColumn("key", F.expr(f"cast(shiftright(xxhash64({of('p', 'w')}, cls), 32) as int)")).where("shares = 1 OR pmod(key, shares) = k")
    longer = longer.select(
        "key", "code", F.col("id").alias("u"), F.col("size").alias("nu"), F.col("group").alias("gu"), "p", *large,
        F.expr(f"CASE WHEN i < t THEN {of('(p + w)', 'cast(next - p - w + w div 2 as int)')} END").alias("a"),
        F.expr(f"CASE WHEN i < t THEN {of('cast(next + w div 2 as int)', 'cast(w div 2 as int)')} END").alias("b"))

    shorter = chunks.withColumn("w", F.explode(F.get(by_size, F.least(F.col("size"), F.lit(short + 1)) - 1)))
    p_from, p_to = "greatest(start, cast(lo * reach as int))", f"least(start + {CHUNK - 1}, size - w, cast((hi + 1) * reach - 1 as int))"
    used = f" AND least((start + {CHUNK - 1}) div reach, hi) div {every} * {every} >= greatest(start div reach, lo)" if every > 1 else ""
    shorter = shorter.withColumn("q", F.explode(F.expr(f"CASE WHEN cls = own AND {p_from} <= {p_to}{used} THEN sequence({p_from}, {p_to}) END")))
    if every > 1:
        shorter = shorter.where(f"q div reach % {every} = 0")
    shorter = shorter.withColumn("key", F.expr(f"cast(shiftright(xxhash64({of('q', 'w')}, cls), 32) as int)")).where("shares = 1 OR pmod(key, shares) = k")
    shorter = shorter.select("key", "code", F.col("id").alias("v"), F.col("size").alias("nv"), F.col("group").alias("gv"), "q", *large,
                             F.expr(of("(q + w)", "w + 2")).alias("c"))
    return longer, shorter


def _segments(lines: DataFrame, similarity: float, first: int = 0, last: int = 1 << 30, every: int = 1) -> tuple[DataFrame, DataFrame]:
    """``id, size, group, line`` -> the keys of every line as the longer of a pair (``key, u, nu, gu, p, a, b``) and as the
    other (``key, v, nv, gv, q, c``), of the ranges ``first`` to ``last`` of ``_parts``. Lines that can reach ``similarity`` share a
    key whose rows ``_follows`` accepts.

    A line of n characters that allows t edits is cut into t + 1 segments. If a line not longer than it is
    within t edits, then on the ring of segments there is one without an edit whose successor has one edit
    at most (pigeonring principle): the segment stands in the other line, at most t characters away, and of its
    successor the first half stands right behind it or the second half does, shifted by one at most. The
    key is of the segment and a class of lengths, and meets others in the part of a range of positions; a segment has the same number
    of characters for all lengths but the smallest, where the other line is cut in each number that can occur."""
    whole = {"code": F.lit(0), "first": F.lit(first), "last": F.lit(last), "k": F.lit(0), "shares": F.lit(1)}
    chunks = _chunks(lines, similarity).withColumn("cls", F.explode(F.array(F.col("own") - 1, F.col("own")))).where("cls >= 0")
    return _keys(chunks.withColumns(whole), similarity, every)


def _follows(similarity: float) -> Column:
    """What two rows of a key must fulfil besides: the edits before the segment and those behind it shift it no farther."""
    return (F.col("gu") != F.col("gv")) & (F.col("nv") <= F.col("nu")) & F.expr(
        f"abs(q - p) + abs(q - p + nu - nv) <= cast(floor({1 - similarity:.6f}D * nu + 1e-9D) as int)") & F.expr(
        "a IS NULL OR startswith(c, a) OR substring(c, length(a), length(b)) = b "
        "OR substring(c, length(a) + 1, length(b)) = b OR substring(c, length(a) + 2, length(b)) = b")


def _in_parts(lines: DataFrame, similarity: float, search, every: int = 1) -> DataFrame:
    """The pairs ``u, v`` that ``search`` finds with the keys of the parts. The keys of a part are cut and meet in one task, to which only
    the texts are shuffled, as the keys take many times the room of the texts; the rows that such a task holds are bounded by PART,
    if need be by a share of the keys of a range for each of several tasks."""
    rows = _classes(lines, similarity)
    ranges, chars, parts = _class(similarity)[2], {r[0]: r[1] for r in rows}, []
    for first, last, least, most in _split(rows, similarity, every):
        shares = math.ceil(chars.get(first // ranges, 0) / ranges / PART / 1.5) if first == last else 1
        parts += [(first, last, k, max(1, shares), least, most) for k in range(max(1, shares))]
    jobs = max(1, min(JOBS // (every // 2 + 1), math.ceil(sum(chars.values()) / (4 * PART))))
    found = []
    for i in range(jobs):
        some = parts[i * len(parts) // jobs:(i + 1) * len(parts) // jobs]
        if some:
            held = lines.where(f"size BETWEEN {some[0][4]} AND {some[-1][5]}")
            pairs = search(*_keys(_dealt(held, similarity, some, every), similarity, every))
            found.append(written(pairs.distinct(), "lines-found"))
    return reduce(DataFrame.unionByName, found).distinct() if found else lines.selectExpr("id AS u", "id AS v").limit(0)


def _meet(rows: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``u, v`` of the rows with a key; those of ``held`` are kept in memory."""
    return rows.join(held.hint("shuffle_hash"), ["code", "key"]).where(_follows(similarity)).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _segment_leaders(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, size, group, line`` -> pairs ``u, v`` of lines with the shortest line of a crowded segment key. A short cut for crowds
    that SimHash blocks leave in pieces: a comparison for each row of a key, where all pairs would be its square. Some keys
    do, as near copies share many, and only where the segment stands in the same range of positions; what they leave open is found
    by ``_segment_pairs``."""
    size_id = F.shiftleft(F.col("nv").cast("long"), 40).bitwiseOR(F.xxhash64("v").bitwiseAND(F.lit((1 << 40) - 1)))

    def part(longer, shorter):
        lead = shorter.groupBy("code", "key").agg(F.min(size_id).alias("lead"), F.count(F.lit(1)).alias("n")).where(f"n > {SMALL}")
        lead = shorter.join(lead.select("code", "key", "lead").hint("shuffle_hash"), ["code", "key"]).where(size_id == F.col("lead"))
        return _meet(longer, lead.drop("lead"), similarity)

    return _in_parts(lines.drop("large"), similarity, part, LEADER_KEYS)


def _segment_pairs(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, size, group, large, line`` -> all pairs ``u, v`` of different groups that can reach ``similarity``, and others.

    Lines of the same group need not meet. In a group of up to SMALL lines they do, and are passed over; those of a
    ``large`` group meet only the rows of other lines with their keys, and lines of two large groups meet by the pairs
    of groups that a key holds, so that no key costs the square of a group."""
    crowds = not lines.where("large").isEmpty()

    def part(longer, shorter):
        if not crowds:
            return _meet(shorter.drop("large"), longer.drop("large"), similarity)
        # that a filter names p or q as well keeps it behind the exchange, which all sides then share
        small, big = [x.where(f"NOT large AND {at} >= 0").drop("large") for x, at in ((longer, "p"), (shorter, "q"))], [
            x.where(f"large AND {at} >= 0").drop("large") for x, at in ((longer, "p"), (shorter, "q"))]
        met = _meet(small[1], longer.drop("large"), similarity).unionByName(_meet(small[0], big[1], similarity))
        held = big[0].select("code", "key", "gu").distinct().join(big[1].select("code", "key", "gv").distinct(), ["code", "key"]).where("gu <> gv")
        both = held.join(big[0], ["code", "key", "gu"]).join(big[1], ["code", "key", "gv"]).where(_follows(similarity))
        return met.unionByName(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))

    return _in_parts(lines, similarity, part)


def _verified(pairs: DataFrame, texts_of, similarity: float) -> DataFrame:
    """The pairs that reach ``similarity``; the texts go to some of the pairs at a time."""
    spark, pairs = pairs.sparkSession, written(pairs, "lines-pairs")
    n = pairs.count()
    parts = min(max(1, math.ceil(n / (BROADCAST // 4))), VERIFY_PARTS)
    links = []
    for i in range(parts):
        some = pairs.where(F.pmod(F.xxhash64("u", "v"), F.lit(parts)) == i)
        ids = some.select(F.explode(F.array("u", "v")).alias("id")).distinct()
        texts = texts_of(F.broadcast(ids) if n <= parts * (BROADCAST // 4) else None)
        a, b = texts.select(F.col("id").alias("u"), F.col("line").alias("a")), texts.select(F.col("id").alias("v"), F.col("line").alias("b"))
        with _set(spark, {COALESCE: "false"}):  # few bytes of pairs are much work
            links.append(written(some.join(a, "u").join(b, "v").where(similar("a", "b", similarity)).select("u", "v"), "lines-links"))
    return reduce(DataFrame.unionByName, links)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               similarity: float = SIMILARITY) -> DataFrame:
    """The line numbers (from 0) to remove: columns ``id``, ``key``, ``removed`` (sorted array), one row
    per document that loses a line.

    Lines are cut at line feeds and normalised; those of at least ``min_words`` words take part (lines without
    a letter or digit never do; under ten characters no edit is within 0.9, so only equal lines are linked). Equal
    normalised lines are one; different ones of whatever length are linked from an edit similarity of
    ``similarity`` on. Of each connected group of linked lines one occurrence stays: that with the smallest
    document id, then key, then line number (null ids last). Lines are first compared with the leaders of
    their SimHash blocks and of some segments, which connects a group of thousands of variants at a comparison for each; then
    all pairs that share a segment as the bound demands (``_segment_pairs``) and are not yet connected.

    A document is an id and a text: rows that repeat both lose the same lines (``key`` is a hash of the
    text). Null and empty texts have no lines that take part. Other columns are not read.
    """
    with _freed(docs.sparkSession):
        return _removed(docs, id_col, text_col, min_words, similarity)


def _removed(docs: DataFrame, id_col: str, text_col: str, min_words: int, similarity: float) -> DataFrame:
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("key"),
        F.posexplode(F.split(normalised(F.col(text_col)), "\n")).alias("no", "line"))
    rows = rows.select("doc", "key", "no", F.trim("line").alias("line"))
    rows = rows.where((F.col("line") != "") & (
        F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) >= min_words - 1))
    rows = written(rows.select(F.unhex(F.md5("line")).alias("id"), F.col("doc").isNull().alias("last"), "doc", "key", "no", "line"),
                   "lines")
    place = F.struct("last", "doc", "key", "no")
    # rows of a document may repeat: they are one occurrence
    distinct = rows.groupBy("id").agg(F.min("line").alias("line"), F.min(place).alias("first"), F.max(place).alias("final"))
    distinct = distinct.withColumnRenamed("id", "hash").withColumn("id", F.monotonically_increasing_id())
    # by size: the search for segments reads a range of sizes at a time
    distinct = written(distinct.withColumn("size", F.length("line")).sortWithinPartitions("size"), "lines-distinct")
    sims = written(simhash(distinct.select("id", "line")), "lines-sim")

    def texts_of(ids):
        texts = distinct.select("id", "line")
        return texts if ids is None else texts.join(ids, "id", "left_semi")

    links = _leader_links(sims, texts_of, similarity)
    groups = written(components(links, "lines"), "lines-groups")
    for search in (_segment_leaders, _segment_pairs) if _most(similarity, 1 << 20) else ():
        large = groups.groupBy("component").agg((F.count(F.lit(1)) > SMALL).alias("large"))
        members = written(groups.join(large, "component").select(F.col("node").alias("id"), "component", "large"), "lines-members")
        grouped = distinct.select("id", "size", "line").join(_few(members), "id", "left").select(
            "id", "size", F.coalesce("component", "id").alias("group"), F.coalesce("large", F.lit(False)).alias("large"), "line")
        more = _verified(search(grouped, similarity), texts_of, similarity)
        if not more.isEmpty():
            groups = groups.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
            groups = written(components(groups, "lines-all"), "lines-groups")
    known = distinct.join(groups.withColumnRenamed("node", "id"), "id", "left")
    known = written(known.where("first <> final OR component IS NOT NULL").select(
        F.col("hash").alias("id"), F.coalesce("component", "id").alias("component"), "first"), "lines-known")
    best = known.groupBy("component").agg(F.min("first").alias("stay"))
    stay = known.join(best, "component").select("id", "stay")
    return (rows.join(stay, "id").where(place != F.col("stay")).groupBy("doc", "key")
            .agg(F.sort_array(F.collect_set("no")).alias("removed"))
            .select(F.col("doc").alias("id"), "key", "removed"))


def _with_removed(docs: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    """``row`` (the input row as one struct, whatever its columns are called) and ``removed`` (null: nothing)."""
    gone = written(duplicates(docs, id_col, text_col, **kw), "lines-removed").withColumnRenamed("id", "gone_id")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(f"`{text_col}`").alias("h"))
    return d.join(_few(gone, F.size("removed")), F.col(f"row.`{id_col}`").eqNullSafe(F.col("gone_id")) & (d["h"] == gone["key"]), "left").select(
        "row", "removed")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per input row: id, ``n_lines``, ``n_removed`` and ``removed`` (line numbers from 0,
    comma-joined). A null or empty text has no lines. Other columns are not read."""
    text = F.col("row.t")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    slim = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    return _with_removed(slim, "i", "t", **kw).select(
        F.col("row.i").alias(id_col), F.when(F.length(text) > 0, lines).otherwise(0).cast("long").alias("n_lines"),
        F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda x: x.cast("string")), ","), F.lit("")).alias("removed"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None,
               **kw) -> DataFrame:
    """The documents without the removed lines, with all their columns, whatever they are called; a document of which no
    word is left, because its lines stand elsewhere, goes. Documents that lose nothing stay as they are, null and empty texts
    too; rows that repeat lose the same lines. ``count_col`` names a column that becomes the length of a changed text."""
    d = _with_removed(docs, id_col, text_col, **kw)
    old = F.col(f"row.`{text_col}`")
    kept = F.array_join(F.filter(F.split(old, "\n"), lambda _, i: ~F.array_contains("removed", i)), "\n")
    d = d.select("row", F.col("removed").isNull().alias("whole"), F.when(F.col("removed").isNull(), old).otherwise(kept).alias("new"))
    d = d.where(F.col("whole") | F.regexp_like("new", F.lit(r"[\p{L}\p{N}]")))
    out = {text_col: F.col("new")}
    if count_col:
        out[count_col] = F.when(F.col("whole"), F.col(f"row.`{count_col}`")).otherwise(F.length("new")).cast(docs.schema[count_col].dataType)
    return d.select([out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
