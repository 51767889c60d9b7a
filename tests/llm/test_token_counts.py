import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kwpulse.llm import queries as Q
from kwpulse.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]


def odd_texts(rnd):
    letters = ["a", "e", "th", "the", "ing", " ", "  ", "\n", "\n\n", "\t", "'", "'s", "'re", "'ll", "'ve", "'l", "1", "23", "²", ".", "...", "é", "ñ",
               "—", "’", "漢字", "🙂", " ", " ", "\x85", "\x1c", "<|endoftext|>", "<|endof", "|>", "İ", "ab" * 20, " " * 9, "-" * 30, "\r\n"]
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(300)]
    return out + ["", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "  <|endoftext|>  ", "can't we'll they're I've", "=" * 300, "a" * 500,
                  "".join(rnd.choice("abcdefgh") for _ in range(400)), "  x   \n\n  y  "]


def test_every_prefix(library):
    texts = odd_texts(random.Random(13))
    c = token_counts.PrefixCounter(PATH)
    for k in (0, 1):  # with an empty and a filled cache
        steps = c.steps(texts)
        assert [len(s) for s in steps] == list(map(len, texts))
        got = [n for s in steps for n in [0, *np.cumsum(s).tolist()]]
        if k == 0:
            want = library([t[:p] for t in texts for p in range(len(t) + 1)])
        assert got == want


def test_bounded_cache(library):
    c = token_counts.PrefixCounter(PATH)
    c.MAX_CACHE, c.GROUP = 10, 50
    texts = odd_texts(random.Random(5))[:100]
    assert [int(s.sum()) for s in c.steps(texts)] == library(texts) and len(c.cache) <= 10


def test_whole_table(spark, library):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    n = library([r["text"] or "" for r in rows])
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), k, k > 512) for r, k in zip(rows, n, strict=True))
    out = Q.op13_token_counts(spark, sf)
    assert sorted(tuple(r) for r in out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == want


def test_questions_from_the_store(spark, library):
    rnd = random.Random(2)
    texts = odd_texts(rnd)[:60] + [None, "", "word " * 40_000, "x" * 50_000]
    rows = [(i, t, "s", 0) for i, t in enumerate(texts)] + [(3, texts[3], "s", 0), (None, "some text", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, steps string, n_tokens int")
    stored = token_counts.prefix_counts(df, PATH, limit=7).cache()
    assert stored.count() == len(rows)
    by = {r["doc_id"]: r for r in stored.collect()}
    assert by[60]["n_tokens"] == by[60]["n_bytes"] == 0 and by[60]["steps"] == b"" and not by[60]["over_limit"]
    asked = [(i, rnd.randint(-1, len(t or "") + 2)) for i, t in enumerate(texts) for _ in range(2)]
    q = spark.createDataFrame([*asked, (5, None), (999, 1)], "doc_id long, chars int")
    got = sorted(tuple(r) for r in token_counts.count_at(stored, q).collect())
    want = [(i, p, k) for (i, p), k in zip(asked, library([(texts[i] or "")[:max(0, p)] for i, p in asked]), strict=True)]
    assert got == sorted(want + [x for x in want if x[0] == 3])
    for r in token_counts.truncated(stored, 7).collect():
        t = "some text" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["chars"] == by[r["doc_id"]]["fits"]
        if len(t) < 1000:
            n = library([t[:p] for p in range(len(t) + 1)])
            assert r["chars"] == max(p for p, k in enumerate(n) if k <= 7)
    assert token_counts.truncated(stored, -1).agg({"chars": "max"}).first()[0] == 0
    assert token_counts.prefix_counts(df.limit(0), PATH).count() == 0
