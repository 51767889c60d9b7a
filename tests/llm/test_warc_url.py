import base64
import hashlib

import duckdb

from kwpulse.llm import queries as Q
from kwpulse.llm import url_filter, warc
from kwpulse.llm.common import shared_path

SF = "/root/testdata/sf0.001"


def brute(rows, least=0):
    first = {}
    for pid, _, html in rows:
        p = (html or "").encode()
        if len(p) >= least:
            first[p] = min(first.get(p, pid), pid)
    out = []
    for pid, _, html in rows:
        p = (html or "").encode()
        f = first.get(p, pid)
        out.append((pid, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "response" if f == pid else "revisit", None if f == pid else f))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("id", "payload_bytes", "payload_digest", "record_type",
                                               "refers_to").collect()), key=str)


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    df = Q.op1_warc(spark, SF)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(str(x) for x in brute(rows))


EDGE = [(1, "http://a/é b\r\nx", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "", "y\r\n\r\nz"),
        (6, "u", "ü" * 300000), (7, "u", "ü" * 300000), (2, None, "x"), (9, "u", "WARC/1.1\r\n\r\n")]


def test_edges(spark):
    df = spark.createDataFrame([(*r, "w") for r in EDGE], "page_id long, url string, html string, record_type string")
    assert got(warc.roundtrip(df)) == brute(EDGE)
    assert got(warc.roundtrip(df, min_revisit_bytes=10)) == brute(EDGE, 10)
    assert warc.roundtrip(df.limit(0)).count() == 0


def test_null_id_and_repeats(spark):
    df = spark.createDataFrame([(None, "u", "a"), (4, "u", "a"), (4, "u", "a"), (None, "u", "b")],
                               "page_id long, url string, html string")
    assert [(r[0], r[3], r[4]) for r in got(warc.roundtrip(df))] == [
        (4, "response", None), (4, "response", None), (None, "response", None), (None, "revisit", 4)]


def test_selected_ranges_and_shuffled_copies(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 900)
    rows = [(i, f"http://h/{i}", "p%d" % (i % 40) * 30) for i in range(200)]
    path = shared_path(spark, "t")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    index = warc.read_index(spark, path)
    assert index.count() == 200
    back = warc.read_records(index.where("id % 3 = 0"), path)
    assert got(back) == [x for x in brute(rows) if x[0] % 3 == 0]
    r = back.where("id = 3").first()
    assert bytes(r["payload"]).decode() == rows[3][2] and r["url"] == rows[3][1]


RULES = [("allow", "org", "/"), ("block", "a.org", "/x"), ("block", "org", "/x"), ("allow", "b.org", "/x"),
         ("block", "b.org", "/x"), ("block", "", "/"), (None, None, None), ("allow", "c.org", None)]
URLS = [None, "", "nohost", "http://", "http://A.ORG/x?y#z", "x://q.a.org", "x://q.a.org/", "http://notorg/x",
        "http://b.org/xy", "http://.org/", "http://a..org/x", "http://org:80/", "ht://a.org/y://b.org/x",
        "http://" + "a." * 3000 + "org/" + "x" * 9000, "http://é.org/x\nfoo", "http://a.org/x"]


def brute_url(u):
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v, h + p) for v, h, p in RULES
            if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best and best[3], best[2] if best else "allow")


def test_url_edges(spark, monkeypatch):
    df = spark.createDataFrame([(i, u, "e") for i, u in enumerate(URLS + URLS)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    want = sorted((i, *brute_url(u)) for i, u in enumerate(URLS + URLS))

    def run(d, r):
        return sorted(map(tuple, url_filter.judge(d, r).collect()), key=lambda x: x[0])
    assert run(df, rules) == want
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert run(df, rules) == want
    assert all(r[3] is None and r[4] == "allow" for r in run(df, rules.limit(0)))
    assert run(df.limit(0), rules) == []
    assert len(run(df.union(df), rules)) == 2 * len(want)
