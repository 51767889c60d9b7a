"""The corpus pipeline: whole runs on small tables, clashing column names, and each stage on its own input."""

import random

import pytest

import corpus_pipeline
from kwpulse.llm import bpe, jaccard, line_dedup
from kwpulse.llm.queries import vocabulary_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, tmp_path, docs, labels=(), items=()):
    for name, rows, schema in (("documents", docs, COLUMNS), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(list(rows), schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(rnd.randint(3, 8))) for _ in range(n))


def row(i, text):
    return (i, text, "en", "web", None if text is None else len(text))


def test_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, folder(spark, tmp_path, []))
    assert out.count() == 0 and "text" not in out.columns and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)


def test_stages_take_out_what_they_should(spark, tmp_path):
    rnd = random.Random(1)
    clean = [row(i, "\n".join(prose(rnd, 14) for _ in range(4))) for i in range(40)]
    item = prose(rnd, 14)
    text = clean[0][1]
    docs = [*clean, row(100, text), row(101, None), row(102, ""), row(103, "ab"), row(103, "ab"), row(None, prose(rnd, 30)),
            row(104, prose(rnd, 20) + " " + item + " " + prose(rnd, 20)),
            row(105, "\n".join([prose(rnd, 40), clean[1][1].split("\n")[2], prose(rnd, 40)]))]
    bad = [row(200 + i, prose(rnd, 10) + " vileword hateword " + prose(rnd, 10)) for i in range(60)]
    labels = [(r[0], 1, int(r[0] >= 200)) for r in [*clean, *bad]]
    out = corpus_pipeline.run(spark, folder(spark, tmp_path, docs + bad, labels, [(1, item), (2, None)]))
    got = {r["doc_id"]: r for r in out.collect()}
    assert {r[0] for r in clean} <= set(got)  # clean documents stay
    assert not {r[0] for r in bad} & set(got) and 100 not in got and 104 not in got
    assert {101, 102, 103, 105, None} <= set(got)
    assert got[105]["n_chars"] < len(docs[-1][1]) and got[105]["lang"] == "en" and got[1]["n_chars"] == clean[1][4]
    assert got[101]["n_tokens"] == 0


def test_clashing_columns(spark):
    rnd = random.Random(2)
    line = prose(rnd, 12)
    names = ["_h", "_id", "_key", "_removed", "_new", "_n", "_words", "row", "removed", "key", "id", "new", "whole", "component_id", "a.b", "th", "n"]
    texts = [f"{prose(rnd, 12)}\n{line}", f"{prose(rnd, 12)}\n{line}", f"{line}", prose(rnd, 30), None]
    data = [(i, t, *[f"{c}{i}" for c in names]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, ["doc_id", "text", *names])
    carried = {r[0]: r[2:] for r in data}
    for out in (line_dedup.drop_lines(df), jaccard.keep_one(df)):
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(tuple(r)[2:] == carried[r["doc_id"]] for r in rows)
    enc = bpe.encode_documents(df.withColumnRenamed("n", "n_tokens"), vocabulary_path(), keep=tuple(c for c in names if c != "n") + ("n_tokens",))
    assert all(r["a.b"] == f"a.b{r['doc_id']}" and isinstance(r["n_tokens"], int) for r in enc.collect())


@pytest.mark.parametrize("n", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_the_schema(spark, tmp_path, n):
    rnd = random.Random(3)
    sf = folder(spark, tmp_path, [row(i, prose(rnd, 12)) for i in range(5)], [(0, 1, 0)], [(1, prose(rnd, 12))])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[n](spark, docs, sf)
    assert out.dtypes == docs.dtypes and sorted(r["doc_id"] for r in out.collect()) == list(range(5))
