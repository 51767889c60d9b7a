import hashlib
import random
import re

import duckdb
import pytest

from kwpulse.llm import decontam
from kwpulse.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=10):
    wins = {}
    for i, t in items:
        w = split(t) if i is not None else []
        for s in range(max(1, len(w) - k + 1)) if w else ():
            wins.setdefault(tuple(w[s:s + k]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                own = wins.get(tuple(w[s:s + n]))
                if own:
                    hit.update(range(s, s + n))
                    found |= own
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    got = sorted((tuple(r) for r in Q.op5_decontamination(spark, sf).collect()), key=str)
    assert got == brute(docs, items) and any(r[-1] for r in got)


@pytest.mark.parametrize("bits, rows", [(26, 200_000), (15, 0)])
def test_edges(spark, monkeypatch, bits, rows):
    monkeypatch.setattr(decontam, "BITS", bits)  # few bits: many false positives of the table
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(decontam, "BATCH", 7 if rows == 0 else 8192)
    rnd = random.Random(4)
    abc = ["a", "b", "é", "D1", "x-y", "Ünï"]
    items = [(i, " ".join(rnd.choices(abc, k=rnd.choice([1, 2, 3, 5, 10, 11, 14])))) for i in range(8)]
    items = [(i, t) for i, t in items if len(split(t)) > 2]
    items += [(20, ""), (21, None), (None, "a b"), (22, "zz"), (22, "yy ÉÉ"), (23, "... !"), (24, items[0][1]), (3, "q r s")]
    docs = [(i, " ".join(rnd.choices(abc, k=rnd.randint(0, 60)))) for i in range(120)]
    docs += [(200, None), (200, None), (201, ""), (None, "zz"), (202, "Zz"), (203, "yy éé"), (204, "yy\x7fÉÉ,"),
             (205, "a " * 100_000 + items[0][1]), (206, "q r"), (207, "q r s"), (207, "p q r s t")]
    df = spark.createDataFrame([(*d, "e", 1) for d in docs], "doc_id long, text string, items string, row int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.mark(df, bench)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute(docs, items)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want
    clean = decontam.mark(df, bench, keep_clean=True)
    assert clean.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in want if not r[-1])
    assert decontam.mark(df.limit(0), bench).count() == 0
    assert decontam.mark(df, bench.limit(0)).where("contaminated").count() == 0


def test_long_repeated_item(spark):
    """An item of 30,000 words in 50 equal rows and one of its passages in many documents."""
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(500)}" for _ in range(30_000)]
    items = [(1, " ".join(long))] * 50 + [(2, " ".join(long[100:140]))]
    docs = [(i, f"own {i} " + " ".join(long[100 + i % 7:130])) for i in range(60)] + [(99, " ".join(long[:9]) + " x")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.mark(df, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)


def test_the_bit_table_takes_few_jobs_and_the_word_cache_is_bounded(spark):
    from kwpulse.llm.common import WordHash
    from kwpulse.llm.decontam import Filter

    sc, conf = spark.sparkContext, "spark.sql.adaptive.coalescePartitions.enabled"
    hashes = spark.range(5000).selectExpr("xxhash64(id) AS h")
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    sc.setJobGroup("bit-table", "bit table")
    try:
        f = Filter(hashes, [3], 10)
    finally:
        spark.conf.set(conf, old)
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("bit-table")) <= 3  # an iterator took one for each of 8 partitions
    bits = {r.h & (f.bits - 1) for r in hashes.collect()}
    assert int(sum(bin(x).count("1") for x in f.table.tolist() if x)) == len(bits)
    cache = WordHash()
    assert len({cache[str(i).encode()] for i in range(100_000)}) == 100_000 and len(cache) <= 1 << 16
