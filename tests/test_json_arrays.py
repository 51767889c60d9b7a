"""Array files read in byte ranges: the records are those of a whole parse."""

from __future__ import annotations

import json
import random

import pytest

from kwpulse.sources import files as IO
from kwpulse.sources import json_arrays


def _odd(rnd):
    text = "".join(rnd.choice(['a', ' ', '"', "\\", "{", "}", "[", "]", ",", "é", "漢", "\n", "\t", "x" * 30]) for _ in range(rnd.randint(0, 25)))
    return {"id": str(rnd.randrange(10**6)), "desc": text, "music": {"title": text[::-1], "author": None},
            "stats": {"a": [1, {"b": "}"}], "c": text}, text or "k": [[], {}]}


def _records(spark, path, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        return [r.value for r in json_arrays.array_records(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("size", ["300b", "4k", "128m"])
def test_records_of_an_array(spark, tmp_path, size):
    rnd = random.Random(3)
    rows = [_odd(rnd) for _ in range(120)] + ["no record", 17, None, [1, 2], {"long": "y" * 5000}, True]
    rnd.shuffle(rows)
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows, indent=2) + "\n", encoding="utf-8")
    (tmp_path / "c.json").write_text("[]")
    got = sorted(json.dumps(json.loads(x)) for x in _records(spark, str(tmp_path), size) if x.strip())
    assert got == sorted([json.dumps(r) for r in rows] * 2)


@pytest.mark.parametrize("size", ["40b", "128m"])
def test_truncated_and_other_files(spark, tmp_path, size):
    files = {'[{"id":"a"},{"id":"b"},{"id":"c"': ['{"id":"a"}', '{"id":"b"}', '{"id":"c"'],
             '[{"id":"a"},{"id":"b"}': ['{"id":"a"}', '{"id":"b"}'],
             '[{"id":"a"},{"id":"b"},': ['{"id":"a"}', '{"id":"b"}'],
             '[{"id":"a"},{"id":"tail': ['{"id":"a"}', '{"id":"tail'],
             '{"id":"a", "b":{"c":1}}': ['{"id":"a", "b":{"c":1}}'], '{"id":1}\n{"id":2}\n': ['{"id":1}', '{"id":2}'],
             "not json": ["not json"], "[1, 2]": ["1", "2"], '["a\\\\", "b\\"}"]': ['"a\\\\"', '"b\\"}"'], "  \n": [], "": []}
    for i, text in enumerate(files):
        (tmp_path / f"{i}.json").write_text(text)
    got = sorted(x.strip() for x in _records(spark, str(tmp_path), size) if x.strip())
    assert got == sorted(x for want in files.values() for x in want)


def test_several_tasks_and_quarantine(spark, tmp_path):
    rows = [{"id": f"v{i}", "desc": "some words " * 20, "stats": {"playCount": i}} for i in range(200)]
    (tmp_path / "big.json").write_text(json.dumps(rows)[:-40])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert lines.rdd.getNumPartitions() >= 2
        good, bad = IO.split_quarantine(IO.read_videos(spark, str(tmp_path), multiline=True))
        assert sorted(r.id for r in good.collect()) == sorted(f"v{i}" for i in range(199)) and bad.count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
