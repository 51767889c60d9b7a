import random

import numpy as np
import pytest

from kwpulse.llm import jaccard
from kwpulse.llm import queries as Q


def brute(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = jaccard.words(t)
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by = {}
    for i, s in enumerate(sets):
        near = {}
        for g in s:
            for j in by.setdefault(g, []):
                near[j] = near.get(j, 0) + 1
            by[g].append(i)
        for j, c in near.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**6)}"
    return " ".join(w)


def corpus(rnd):
    """Families of near copies with all distances, a shared passage, short and odd texts."""
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: rnd.choices(vocab, k=n)
    passage = text(60)
    texts = []
    for n, family in ((120, 60), (300, 12), (40, 12), (9, 8), (4, 8), (1500, 4)):
        base = text(n)
        texts += [edited(rnd, base, rnd.randint(0, max(1, n // 25))) for _ in range(family)]
    texts += [" ".join(text(rnd.randint(5, 80)) + passage + text(rnd.randint(5, 80))) for _ in range(60)]
    texts += ["a b", "A B", "a  b\n", "b a", "a", "", None, " \t", "é b c", "É b c", "x " * 300, "x " * 301, "x y z", "x y z x y z"]
    texts += [texts[0]] * 20
    rows = list(enumerate(texts, 100))
    rnd.shuffle(rows)
    return rows + [(5, texts[3]), (5, texts[3]), (5, "another text of this id"), (None, texts[3]), (None, "nobody else has this"), (None, None)]


@pytest.mark.parametrize("k,num,den,tiny", [(3, 90, 100, False), (3, 90, 100, True), (5, 80, 100, True), (1, 70, 100, True), (2, 1, 1, False)])
def test_against_brute_force(spark, monkeypatch, k, num, den, tiny):
    if tiny:
        for name, x in (("LEAF", 6), ("TILE", 4), ("PIVOTS", 3), ("MOST_PIVOTS", 4), ("LOCAL", 2), ("FREQUENT", 3), ("FEW", 3)):
            monkeypatch.setattr(jaccard, name, x)
    rows = corpus(random.Random(k * 100 + num))
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, component_id string").repartition(3)
    assert got(jaccard.groups(df, k=k, num=num, den=den)) == brute(rows, k, num, den)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, 3, 90, 100)
    assert got(Q.op4_jaccard(spark, sf)) == want and any(d != c for d, _, c in want)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(7)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for num, den in ((90, 100), (80, 100), (7, 10), (1, 1)):
        bound = jaccard.Bound(num, den)
        for _ in range(400):
            n = int(rng.choice([1, 2, 3, 5, 8, 9, 10, 12, 18, 20, 40, 100, 300, 301, 1000]))
            base = np.unique(rng.integers(0, 2**63, n + 400, dtype=np.uint64))
            x = np.sort(base[:n])
            off = int(rng.integers(0, bound.most_different(n, n) + 2))
            drop = int(rng.integers(0, min(off, n - 1) + 1))
            y = np.sort(np.concatenate([x[rng.permutation(n)[drop:]], base[n:n + off - drop]]))
            inter = len(np.intersect1d(x, y))
            freq = none if rng.random() < 0.5 else (np.sort(x[: max(1, int(n * rng.random()))]), np.full(max(1, n), 5, np.int64))
            sx, sy = (jaccard.signatures(v, bound, *freq)[0] for v in (x, y))
            if bound.linked(inter, len(x), len(y)):
                assert len(np.intersect1d(sx, sy)), (num, n, drop, off)
                h = [np.frombuffer(jaccard.histogram(v), "<u2").astype(int) for v in (x, y)]
                assert np.abs(h[0] - h[1]).sum() <= bound.most_different(len(x), len(y))


def test_keep_one(spark):
    a, b = "one two three four five six seven", "completely other words are standing in here now"
    rows = [(3, a, "r"), (1, a, "s"), (2, b, "t"), (2, b, "t"), (7, "", "u"), (8, None, "v"), (8, None, "v"), (9, "", "w"), (1, b, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == [(1, b), (1, a), (7, ""), (8, ""), (8, ""), (9, "")] or \
        sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == sorted([(1, a), (1, b), (7, ""), (8, ""), (8, ""), (9, "")])
    assert jaccard.keep_one(df.limit(0)).count() == 0 and jaccard.groups(df.limit(0)).count() == 0
