import math
import random
from fractions import Fraction

import pytest

from kwpulse.llm import queries as Q
from kwpulse.llm import topk


def brute(rows, k=5, every=50, scale=256):
    vec = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vec.append((i, [math.floor(Fraction(x) * scale) if abs(x) > 1e200 else math.floor(scale * x) for x in v]))
    queries = {}
    for i, q in vec:
        if i % every == 0:
            queries.setdefault(i, q)
    out = []
    for i, q in queries.items():
        s = sorted((-sum(a * b for a, b in zip(q, w, strict=True)), j) for j, w in vec if j != i and len(w) == len(q))
        out += [(i, r, j, max(-2**63, min(2**63 - 1, -x))) for r, (x, j) in enumerate(s[:k], 1)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in topk.top_k(df, **kw).collect())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in Q.op3_topk(spark, sf).collect()) == brute(rows)


@pytest.mark.parametrize("small", [False, True])
def test_edges(spark, monkeypatch, small):
    if small:
        for name, x in (("BUCKET", 7), ("QUERIES", 3), ("SEED", 4), ("COSINE", 0.2)):
            monkeypatch.setattr(topk, name, x)
    rnd = random.Random(3)
    vec = lambda s=1.0: [rnd.gauss(0, s) for _ in range(12)]
    same = vec()
    rows = [(i, vec(rnd.choice([0.1, 1, 5]))) for i in range(1, 300)] + [(1000 + i, same) for i in range(150)]
    rows += [(2000, None), (2050, [None] * 12), (2100, [math.nan] * 12), (2150, [math.inf] * 12), (2200, [1e30] * 12),
             (2250, []), (2251, []), (2300, [1.0]), (2350, [0.0] * 12), (-50, vec()), (None, vec()), (4, same)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, rank int")
    assert run(df) == brute(rows)
    assert run(df, k=2, every=7) == brute(rows, 2, 7)
    assert run(df.limit(0)) == []


def test_large_components(spark):
    """Components beyond 2**24 after scaling, scores at and beyond the bounds of a long, floats whose scaled value is infinite."""
    probe = [(50, [70000.0, 0.0]), (1, [1.0, 0.0]), (2, [70001.0, 0.0]), (100, [1.0, 0.0])]
    rnd = random.Random(8)
    sizes = [1e-3, 1.0, 65536.0, 65537.0, 1e6, 1e9, 1e15, 1e160, 1.5e308]
    rows = [(i, [rnd.gauss(0, 1) * 10 ** rnd.randint(0, 1), rnd.gauss(0, 1)]) for i in range(200, 320)]
    rows += [(i, [rnd.choice(sizes) * rnd.choice([-1, 1]), rnd.choice(sizes) * rnd.uniform(-1, 1)]) for i in range(400, 560)]
    rows += [(2**31 * 50, [float(2**31), 0.0]), (9, [float(2**24), 0.0]), (11, [-float(2**24) - 1, 0.0])]
    for data in (probe, probe + rows):
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
        assert run(df) == brute(data)
        assert run(df, k=3, every=20) == brute(data, 3, 20)
