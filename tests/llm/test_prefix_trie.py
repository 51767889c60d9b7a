import hashlib
import random
import zlib

import numpy as np
import pytest

from kwpulse.llm import prefix_trie
from kwpulse.llm import queries as Q


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    nodes = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        s = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(s) + 1):
            m, e = nodes.setdefault(tuple(s[:d]), ([], []))
            m.append(c)
            if d == len(s):
                e.append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, (m, _) in nodes.items():
        for e in range(len(p) + 1):
            leaves[p[:e]] += children[p] == 0
            saved[p[:e]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((m[0], len(p), nodes[p[:-1]][0][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()) for p, (m, e) in nodes.items()), key=str)


def got(df):
    cols = [c.split()[0] for c in prefix_trie.NODE.split(", ")]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def corpus(rnd):
    rows = [(500 + i, t, "user", f"same {t}") for i in range(0, 140) for t in range(6)]  # copies over many blocks
    words = ["a", "b", "", None, "é🙂", "long text " * 5]
    for c in range(0, 420):
        rows += [(c, t, rnd.choice(["user", "user", None, "bot"]), rnd.choice(words)) for t in range(rnd.randint(1, 7))]
    rows += [(1000 + i, 0, "r", "x") for i in range(20)]  # turnless, where the head is absent
    rows += [(77, None, "user", "first"), (77, 3, "user", "tie"), (77, 3, "user", "eit"), (None, 0, "user", "nobody"), (-7, 0, "u", "m"),
             (-100, 0, "u", "base"), (9000, 1, "user", "1"), (9000, 1, "user", "1")]
    rows += [(2001, t, "user", f"t{t}") for t in range(300)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows_of_a_block,turns", [(8192, 65_536), (7, 65_536), (50, 40)])
def test_against_brute_force(spark, rows_of_a_block, turns):
    rows = corpus(random.Random(rows_of_a_block))
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    assert got(prefix_trie.trie(df.repartition(5), rows_of_a_block, turns)) == brute(rows)


def test_small_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert got(prefix_trie.trie(spark.createDataFrame([], schema))) == []
    for rows in ([(1, 0, "u", "x")], [(100, 0, "u", "x")], [(None, 0, "u", "x")], [(100, 0, None, None), (200, 0, "", "")]):
        assert got(prefix_trie.trie(spark.createDataFrame(rows, schema))) == brute(rows)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.op12_prefix_trie(spark, sf)) == brute(rows)


def test_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 100):
        v = rng.integers(0, 9, n)
        table = prefix_trie.Minima(v)
        lo = rng.integers(0, n, 200)
        hi = np.minimum(lo + rng.integers(0, n, 200), n - 1)
        assert table.least(lo, hi).tolist() == [v[a:b + 1].min() for a, b in zip(lo, hi, strict=True)]
