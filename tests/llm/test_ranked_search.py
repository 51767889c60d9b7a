import math
import random
import re

import pytest

from kwpulse.llm import queries as Q
from kwpulse.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, k=50):
    tf, df, total, n_docs = [], {}, 0, 0
    for i, t in docs:
        own = {}
        for w in cut(t):
            own[w] = own.get(w, 0) + 1
        tf.append((i, sum(own.values()), own))
        total += sum(own.values())
        n_docs += bool(own)
        for w in own:
            df[w] = df.get(w, 0) + 1
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for w, x in df.items()}
    wanted = {}
    for i, t in items:
        if i is not None and cut(t):
            wanted.setdefault(i, set()).update(cut(t))
    out = []
    for item, terms in wanted.items():
        s = []
        for i, n, own in tf:
            m = 50 + 50 * n * n_docs // total if total else 0
            s.append((-sum(weight[w] * (10**9 * own[w] // (1000 * own[w] + 20 * m)) for w in terms if w in own), i is None, i or 0))
        out += [(item, r, None if none else i, -x) for r, (x, none, i) in enumerate(sorted(s)[:k], 1) if x < 0]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(rnd):
    vocab = [f"w{i}" for i in range(60)] + ["The", "of", "É", "é", "漢字", "x1", "_", "don't", "A-b"]
    weights = [1 / (1 + i) for i in range(len(vocab))]
    text = lambda n: " ".join(rnd.choices(vocab, weights, k=n))
    docs = [(i, text(rnd.randint(1, 80))) for i in range(300)] + [(1000 + i, "the same of w1 w2") for i in range(80)]
    docs += [(7, text(5)), (7, "the same of w1 w2"), (None, "the same of w1 w2"), (None, "w3"), (400, None), (401, ""), (402, "--"), (403, text(20_000))]
    rnd.shuffle(docs)
    items = [(i, text(rnd.randint(1, 30))) for i in range(40)] + [(50, None), (51, ""), (52, "!"), (None, "w1"), (53, "nowhere"), (3, "w40 w41"), (4, "w1"), (4, "w1")]
    return docs, items


@pytest.mark.parametrize("k,block", [(50, 200_000), (3, 200_000), (7, 130)])
def test_against_brute_force(spark, k, block):
    docs, items = corpus(random.Random(k))
    d = spark.createDataFrame([(*r, 0, 0) for r in docs], "doc_id long, text string, item long, score int").repartition(4)
    i = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, term int")
    assert got(ranked_search.search(d, i, k=k, block_pairs=block)) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = corpus(random.Random(1))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked_search.search(d.limit(0), i)) == got(ranked_search.search(d, i.limit(0))) == []
    assert got(ranked_search.search(d.where("doc_id = 400"), i)) == []
    named = spark.createDataFrame([("a", "w1 w2"), ("b", "w1")], "item_id string, text string")
    assert got(ranked_search.search(d, named)) == brute(docs, [("a", "w1 w2"), ("b", "w1")])


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(Q.op11_ranked_search(spark, sf)) == brute(docs, items)


@pytest.mark.parametrize("most", [64, 3])
def test_dag_keeps_every_term_once_and_shares(monkeypatch, most):
    monkeypatch.setattr(ranked_search, "ACTIVE", most)
    rnd = random.Random(4)
    items = [sorted(rnd.sample(range(40), rnd.randint(0, 20))) for _ in range(30)] + [[40, 41, 42], [40, 41, 43]]
    dag = ranked_search.SharingDag(items, 44)
    terms = {s: [t for t in range(44) if dag.leaf[t] == s] for s in range(dag.nodes)}
    for node, a, b in dag.joins:
        terms[node] = terms[a] + terms[b]
    for i, own in enumerate(items):
        assert sorted([t for x in dag.roots[i] for t in terms[x]] + [t for t in range(44) if dag.single[t] == i]) == own
    assert dag.leaf[40] == dag.leaf[41] and dag.single[42] == 30
    if most == 64:
        additions = len(dag.joins) + sum(map(len, dag.roots))
        assert additions < 0.75 * sum(map(len, items))
