import hashlib
import random
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kwpulse.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def voc():
    return bpe.vocabulary(PATH)


TEXTS = ["", " ", "a", "Hello, World's 42nd", "aaaaaaaaaaaaaaaaaaaa", "thththth" * 50, "x" * 5000, "Été naïve ß İstanbul",
         "Σίσυφος ΟΔΟΣ", "你好 世界", "é å", "\U0001f600\U0001f468‍\U0001f469 ok",
         "<|endoftext|> hi<|startoftext|>x", "<|ENDOFTEXT|> <| |>", "a b c\x85d\x1ce​f", "don't we'll I'M '''s",
         "²½ 12٣", "\t\n\r\x0b\x0cz", "\x00\x01", "ǅǆ ŉ ǰ ﬁ", "zªºʰ"]


def test_against_the_library(voc, lib):
    rnd = random.Random(1)
    alphabet = "abcdehinorstl " * 5 + "éàüß'.,!-09\n@"
    texts = TEXTS + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 300))) for _ in range(1500)]
    for t, x in zip(texts, voc.encode(texts), strict=True):
        want = lib.encode(t, add_special_tokens=False).ids
        assert x.tolist() == want, t
        assert voc.decode(x) == lib.decode(want, skip_special_tokens=False), t


def test_pair_checks_equal_exact_merging(voc):
    rng = np.random.default_rng(2)
    n = 49406
    plain = np.array([i for i in range(n) if not voc.text[i].endswith("</w>")])
    common = plain[plain < 3000]
    a = np.concatenate([rng.choice(plain, 6000), rng.choice(common, 6000), common[:300]])
    b = np.concatenate([rng.integers(0, n, 6000), rng.integers(0, 3000, 6000), common[:300]])
    want = [voc.merge(voc.text[i] + voc.text[j]) == [i, j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    own = {i for i in {*a.tolist(), *b.tolist()} if voc.merge(voc.text[i]) == [i]}
    keep = np.array([i in own and j in own for i, j in zip(a.tolist(), b.tolist(), strict=True)])
    assert (voc.compatible(a, b)[keep] == np.array(want)[keep]).all()
    assert 0 < sum(want) < len(want)


def test_documents(spark, lib):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows += [(900_000 + i, t) for i, t in enumerate(TEXTS)] + [(7, None), (7, None), (None, "word"), (8, "long " * 200_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    got = bpe.encode_documents(df, PATH).collect()
    want = []
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0


def test_ids_and_kept_columns(spark):
    df = spark.createDataFrame([(1, "the cat", "k")], "doc_id long, text string, lang string")
    r = bpe.encode_documents(df, PATH, keep=("text", "lang"), with_ids=True).first()
    assert (r["text"], r["lang"], len(r["ids"])) == ("the cat", "k", r["n_tokens"]) and r["decoded"] == "the</w> cat</w>"
