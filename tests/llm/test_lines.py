import glob
import random
import re

import pytest

from kwpulse.llm import line_dedup
from kwpulse.llm import queries as Q


def norm(t):
    return [re.sub(r"[\W_]+", " ", x.lower()).strip() for x in t.split("\n")]


def removed(df):
    return {(r["doc_id"], i) for r in df.collect() for i in ([int(x) for x in r["removed"].split(",")] if r["removed"] else [])}


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = Q.op6_line_dedup(spark, sf).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    gone = {(d, int(i)) for d, r in by.items() if r["removed"] for i in r["removed"].split(",")}
    first, kept = {}, {}
    for d, t in sorted(rows):
        assert by[d]["n_lines"] == t.count("\n") + 1
        for i, x in enumerate(norm(t)):
            if not x:
                assert (d, i) not in gone
            elif (d, i) not in gone:
                assert x not in kept  # a line stays once
                kept[x] = (d, i)
            first.setdefault(x, (d, i))
    assert all(kept.get(x, p) == p for x, p in first.items())  # ... and it is the first
    whole = sorted({x for d, t in rows for i, x in enumerate(norm(t)) if (d, i) in gone} - set(kept))
    for x in whole[:10]:  # a line that went entirely has an alike one
        own = set(x.split())
        near = sorted((y for y in first if y != x), key=lambda y: -len(own & set(y.split())) / len(own | set(y.split())))[:2]
        assert any(lev(x, y) <= 0.1 * max(len(x), len(y)) for y in near if len(y) < 1000)


BASE = "the quick brown fox jumps over the lazy dog near the old stone bridge by the river every single morning in spring"


@pytest.mark.parametrize("crowded", [False, True])
def test_groups(spark, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(line_dedup, "SMALL", 2)
    rnd = random.Random(6)
    rows = [(i, f"Document {i} has own opening words {rnd.random()}\n{BASE[:-1]}{'.' * (i % 3)}\nshort line\n{BASE} {'ab'[i % 2]}") for i in range(30)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, BASE + " a"), (103, BASE.upper() + " A"), (103, BASE.upper() + " A"),
             (104, "é " * 30_000), (105, "É " * 30_000), (106, " ".join(f"x{i}" for i in range(3000))),
             (107, " ".join(f"x{i}" for i in range(2990)))]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, removed string")
    out = line_dedup.report(df)
    gone = removed(out)
    assert len(out.collect()) == len(rows)
    assert {(i, 1) for i in range(1, 30)} <= gone and {(i, 3) for i in range(30)} <= gone
    assert {(i, 2) for i in range(1, 30)} <= gone and not {(0, 1), (0, 2)} & gone
    assert not {(i, 0) for i in range(30)} & gone
    assert {(103, 0), (None, 0), (105, 0)} <= gone and (104, 0) not in gone
    kept = line_dedup.drop_lines(df, count_col=None)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 103 not in ids and None not in ids and 105 not in ids and {100, 101, 102, 104} <= set(ids)
    t = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert t[5].split("\n")[1:] == [] and t[0] == rows[0][1].rsplit("\n", 1)[0]
    assert line_dedup.report(df.limit(0)).count() == 0 and line_dedup.drop_lines(df.limit(0)).count() == 0


def test_equal_rows_lose_the_same(spark):
    df = spark.createDataFrame([(1, BASE), (1, BASE), (2, BASE), (3, "a b c d e\na b c d e")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["removed"]) for r in line_dedup.report(df).collect())
    assert got == [(1, ""), (1, ""), (2, "0"), (3, "1")]


def edited(rnd, x, cuts):
    """``x`` with an edit in each of ``cuts`` equal parts."""
    out = []
    for i in range(cuts):
        part = x[i * len(x) // cuts:(i + 1) * len(x) // cuts]
        j = rnd.randrange(1, len(part) - 1)
        out.append([part[:j] + "q" + part[j + 1:], part[:j] + "q" + part[j:], part[:j] + part[j + 1:]][rnd.randrange(3)])
    return "".join(out)


def within(a, b):
    """Edit similarity 0.9 by the whole band of the distance table."""
    most = int(0.1 * max(len(a), len(b)) + 1e-9)
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            new[j] = i if j == 0 else min(row.get(j, most) + 1, new.get(j - 1, most) + 1, row.get(j - 1, most + 1) + (x != b[j - 1]))
        row = new
        if not row or min(row.values()) > most:
            return False
    return row.get(len(b), most + 1) <= most


def test_all_pairs_within_the_bound(spark):
    """Lines of all lengths, each with copies that have their edits spread as evenly as the bound allows."""
    rnd = random.Random(11)
    lines = set()
    for words in (5, 6, 7, 8, 9, 10, 12, 14, 17, 20, 30, 50, 100, 180, 260):
        for _ in range(4):
            x = " ".join("".join(rnd.choice("abcdefghiklmnoprstuvwz") for _ in range(rnd.randint(1, 9))) for _ in range(words))
            lines |= {x, *(norm(edited(rnd, x, max(1, len(x) // n)))[0] for n in (10, 20) if len(x) >= 10)}
    lines = sorted(x for x in lines if len(x.split()) >= 5)
    near = [(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines[:i]) if within(x, y)]
    group = list(range(len(lines)))
    for _ in range(4):
        for i, j in near:
            group[i] = group[j] = min(group[i], group[j])
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert removed(line_dedup.report(df)) == {(i, 0) for i, g in enumerate(group) if g != i}
    assert len(near) > 80


def test_word_order_counts_in_long_lines(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghiklmnop") for _ in range(6)) for _ in range(300)]
    turned = " ".join(reversed(words))
    df = spark.createDataFrame([(1, " ".join(words)), (2, turned)], "doc_id long, text string")
    assert removed(line_dedup.report(df)) == set()


def test_fit_and_unfit_lines_of_a_crowded_block(spark, monkeypatch):
    """A line near a leader's follower, but not near the leader, is linked however crowded the block is."""
    monkeypatch.setattr(line_dedup, "SMALL", 1)
    monkeypatch.setattr(line_dedup, "BLOCKS", ((0, 0), (0, 0), (0, 0)))  # all lines share every block
    rnd = random.Random(5)
    x = " ".join("".join(rnd.choice("abcdefghiklmnop") for _ in range(6)) for _ in range(30))
    steps = [x]
    for i in range(4):  # each 0.93 of the one before, the ends far apart
        steps.append("".join("q" if j % 14 == 3 * i and c != " " else c for j, c in enumerate(steps[-1])))
    other = [" ".join("".join(rnd.choice("abcdefghiklmnop") for _ in range(6)) for _ in range(30)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(steps + other)), "doc_id long, text string")
    assert removed(line_dedup.report(df)) == {(i, 0) for i in range(1, 5)}


@pytest.mark.parametrize("words", [1, 5])
def test_short_lines(spark, words):
    """Equal short lines go from the second on, unless the caller asks for longer lines only; blank ones stay."""
    df = spark.createDataFrame([(1, "Yes!\n\n- -\nsee above"), (2, "yes\n\n---\nSee above."), (3, "yet\nsee abode")], "doc_id long, text string")
    assert removed(line_dedup.report(df, min_words=words)) == (set() if words == 5 else {(2, 0), (2, 3)})


def test_pairs_of_large_groups(spark, monkeypatch):
    """Lines of large groups meet those of other groups, large and small, but not their own."""
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    rnd = random.Random(8)
    x = " ".join("".join(rnd.choice("abcdefghiklmnop") for _ in range(6)) for _ in range(30))
    step = ["".join("q" if j % 13 < k and c != " " else c for j, c in enumerate(x)) for k in (0, 1, 2)]  # ends too far apart
    lines = [(i, g, s + " z" * i) for g, s in enumerate(step) for i in range(4 if g < 2 else 1)]
    rows = [(10 * g + i, len(s), 10 * g, g < 2, s) for i, g, s in lines]
    df = spark.createDataFrame(rows, "id long, size int, group long, large boolean, line string")
    got = {tuple(r) for r in line_dedup._segment_pairs(df, 0.9).collect()}
    near = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and a[2] != b[2] and within(a[4], b[4])}
    assert near <= got and len(near) > 5 and all(u // 10 != v // 10 for u, v in got)


def near_lines(rnd):
    """Lines of many lengths, each with an edited copy, and the group of its own for each."""
    lines = []
    for words in (2, 3, 4, 6, 9, 14, 30, 80, 200):
        for _ in range(6):
            x = " ".join("".join(rnd.choice("abcdefghiklmnoprstuvwz") for _ in range(rnd.randint(2, 9))) for _ in range(words))
            lines += [x, norm(edited(rnd, x, max(1, len(x) // 11)))[0]]
    return [(i, len(x), i, False, x) for i, x in enumerate(lines)]


@pytest.mark.parametrize("crowded", [False, True])
def test_keys_in_parts(spark, monkeypatch, crowded):
    """The keys are shuffled in parts of a bounded share; together these hold each key once and find the same pairs."""
    rows = [(i, n, g - g % 4 if crowded and n > 100 else g, crowded and n > 100, x) for i, n, g, _, x in near_lines(random.Random(12))]
    df = spark.createDataFrame(rows, "id long, size int, group long, large boolean, line string")
    whole = {tuple(r) for r in line_dedup._segment_pairs(df, 0.9).collect()}
    near = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and a[2] != b[2] and within(a[4], b[4])}
    assert near <= whole and len(near) > (5 if crowded else 20)
    monkeypatch.setattr(line_dedup, "PART", 2500)
    parts = line_dedup._parts(df, 0.9)
    assert len(parts) > 5
    assert {tuple(r) for r in line_dedup._segment_pairs(df, 0.9).collect()} == whole
    if not crowded:
        keys = [sorted(r[0] for r in x.select("key").collect()) for x in line_dedup._segments(df, 0.9)]
        cut = [line_dedup._segments(df.where(f"size BETWEEN {n} AND {m}"), 0.9, i, j) for i, j, n, m in parts]
        held = [[r[0] for r in x[1].select("key").collect()] for x in cut]
        assert sorted(k for x in held for k in x) == keys[1] and max(map(len, held)) < len(keys[1]) / 3
        assert set(keys[0]) & set(keys[1]) <= {r[0] for x in cut for r in x[0].select("key").collect()}


def test_shuffle_files_go(spark):
    """No job of the search leaves its shuffle files until the driver's garbage is collected, and the setting is as before."""
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for d in store.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*")}

    before, setting = files(), spark.conf.get(line_dedup.CLEANUP)
    df = spark.createDataFrame([(i, x) for i, _, _, _, x in near_lines(random.Random(13))], "doc_id long, text string")
    line_dedup.duplicates(df)
    assert not files() - before
    assert spark.conf.get(line_dedup.CLEANUP) == setting


def test_pairs_verified_in_parts(spark, monkeypatch):
    """However many pairs there are, in however many parts they meet their texts, the same links are found."""
    rows = near_lines(random.Random(14))
    texts = spark.createDataFrame([(i, x) for i, _, _, _, x in rows], "id long, line string")
    pairs = spark.createDataFrame([(a, b) for a in range(len(rows)) for b in range(max(0, a - 3), a)], "u long, v long")
    near = {(a, b) for a, b in map(tuple, pairs.collect()) if within(rows[a][4], rows[b][4])}
    for few, parts in ((200_000, 16), (400, 16), (100, 2)):
        monkeypatch.setattr(line_dedup, "BROADCAST", few)
        monkeypatch.setattr(line_dedup, "VERIFY_PARTS", parts)
        asked = []

        def texts_of(ids, asked=asked):
            asked.append(ids)
            return texts if ids is None else texts.join(ids, "id", "left_semi")

        got = [tuple(r) for r in line_dedup._verified(pairs, texts_of, 0.9).collect()]
        assert set(got) == near and len(got) == len(near) and len(near) > 20
        assert len(asked) == {200_000: 1, 400: 4, 100: 2}[few] and (None in asked) == (few == 100)


def test_keys_meet_in_the_task_that_cuts_them(spark):
    """The texts are shuffled, once for both sides, and no key is; no generated method is too long to be compiled; parts and shares
    of a part go to a task each and find the same pairs."""
    rows = near_lines(random.Random(15))
    df = spark.createDataFrame(rows, "id long, size int, group long, large boolean, line string")
    near = {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0] and within(a[4], b[4])}
    whole = {tuple(r) for r in line_dedup._segment_pairs(df, 0.9).collect()}
    assert near <= whole and len(near) > 20
    parts = [(i, j, k, 2, n, m) for i, j, n, m in line_dedup._parts(df, 0.9) for k in range(2)]
    with line_dedup._freed(spark), line_dedup._set(spark, {"spark.sql.adaptive.enabled": "false"}):
        dealt = line_dedup._dealt(df, 0.9, parts, 1)
        assert sorted(r[0] for r in dealt.selectExpr("spark_partition_id()").distinct().collect()) == list(range(len(parts)))
        longer, shorter = line_dedup._keys(dealt, 0.9)
        met = line_dedup._meet(shorter, longer, 0.9)
        assert {tuple(r) for r in met.collect()} == whole
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode
        plan = met._jdf.queryExecution().explainString(mode.fromString("simple"))
        assert set(re.findall(r"hashpartitioning\((\w+)#\d+, \d+\)", plan)) == {"code"} and "ShuffledHashJoin" in plan
        code = met._jdf.queryExecution().explainString(mode.fromString("codegen"))
        assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
