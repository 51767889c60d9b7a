"""JSON array files read by many tasks: record boundaries by a parity scan over byte ranges.

A file is cut at its closing braces by Spark's text source, so each byte range is a task's own, on one line or on many. Whether
a range begins inside a string, and how deep, depends on all before it. So a first pass maps, for each range, every
state it may begin in to the one it ends in and the change of depth; these maps are combined from range to range (a few
numbers each); a second pass, over the ranges again, then cuts the records. A record that crosses ranges is put together from its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kwpulse.sources.files import stored

BROADCAST = 200_000  # ranges whose states are sent to all tasks
OUT, IN, ESCAPED = 0, 1, 2  # outside a string, inside, after a backslash inside
_STRING_END = re.compile(rb'(?:[^"\\]|\\.)*+"', re.S)
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*+(?:"|\\?\Z)|[\[\]{},]|[^\s"\[\]{},]++', re.S)


def _left_string(chunk: bytes, state: int) -> tuple[int, int]:
    """(where the string that a chunk begins in is over, the state there or at the chunk's end)."""
    if state == OUT:
        return 0, OUT
    at = 1 if state == ESCAPED else 0
    end = _STRING_END.match(chunk, at)
    if end:
        return end.end(), OUT
    return len(chunk), _open_string(chunk[at:])


def _open_string(rest: bytes) -> int:
    """The state at the end of a string's inside that is not over."""
    return ESCAPED if (len(rest) - len(rest.rstrip(b"\\"))) % 2 else IN


def _tokens(chunk: bytes, at: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(first byte, start, end, state at the end) of what stands outside of strings, strings as one token."""
    for m in _TOKEN.finditer(chunk, at):
        first = chunk[m.start():m.start() + 1]
        if first == b'"':
            closed = m.end() - m.start() > 1 and chunk[m.end() - 1:m.end()] == b'"' and _open_string(chunk[m.start() + 1:m.end() - 1]) == IN
            yield first, m.start(), m.end(), OUT if closed else _open_string(chunk[m.start() + 1:m.end()])
        else:
            yield first, m.start(), m.end(), OUT


def _effect(chunk: bytes, state: int) -> tuple[int, int]:
    """(state at the end, change of depth) of a chunk that begins in ``state``."""
    at, state = _left_string(chunk, state)
    depth = 0
    if state == OUT:
        for first, _, _, after in _tokens(chunk, at):
            depth += (first in b"[{") - (first in b"]}")
            state = after
    return state, depth


class Records:
    """Cuts the records of one range. ``base`` is the depth at which records stand: 1 in an array, else 0."""

    def __init__(self, state: int, depth: int, base: int, begins: bool):
        self.state, self.depth, self.base = state, depth, base
        self.open = not begins and (base == 1 or depth > 0 or state != OUT)
        self.begun = False  # the open record began in this range
        self.held: list[bytes] = []
        self.out: list[tuple[bytes, bool, bool]] = []  # text, begins here, ends here

    def _close(self, ends: bool = True) -> None:
        if self.open:
            self.out.append((b"".join(self.held), self.begun, ends))
        self.open, self.held = False, []

    def feed(self, chunk: bytes) -> None:
        start = 0  # of the open record's text in this chunk
        at, self.state = _left_string(chunk, self.state)
        for first, i, j, after in _tokens(chunk, at) if self.state == OUT else ():
            self.state = after
            level = self.depth == self.base
            if level and self.base and first in b",]" or self.base and self.depth < self.base and first == b"[":
                if self.open:
                    self.held.append(chunk[start:i])
                    self._close()
                self.depth += (first == b"[") - (first == b"]")
                continue
            if not self.open:
                if first == b"," and self.depth <= self.base:
                    continue
                self.open, self.begun, start = True, True, i
            self.depth += (first in b"[{") - (first in b"]}")
            if not self.base and self.depth <= 0 and first in b"]}":
                self.held.append(chunk[start:j])
                self._close()
        if self.open:
            self.held.append(chunk[start:])

    def end(self) -> None:
        self._close(ends=False)


def _chunks(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, bytes]]:
    """Every chunk with its range: (file, start, ...), chunk."""
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("file", "start", *more, "chunk")]
        for *key, chunk in zip(*cols, strict=True):
            yield tuple(key), chunk


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, key, ends, depth, size, first = [], None, None, None, 0, None

    def done():
        rows.append({"file": key[0], "start": key[1], "total": key[2], "size": size, "first": first,
                     **{f"e{s}": ends[s] for s in range(3)}, **{f"d{s}": depth[s] for s in range(3)}})

    for k, chunk in _chunks(batches, "total"):
        if k != key:
            if key is not None:
                done()
            key, ends, depth, size, first = k, [0, 1, 2], [0, 0, 0], 0, None
        text = chunk + b"}"
        size += len(text)
        first = first or text.strip()[:1]
        effect: dict[int, tuple[int, int]] = {}
        for s in range(3):
            e = effect.setdefault(ends[s], None) or _effect(text, ends[s])
            effect[ends[s]] = e
        for s in range(3):
            e = effect[ends[s]]
            ends[s], depth[s] = e[0], depth[s] + e[1]
    if key is not None:
        done()
    if rows:
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows).astype({"first": object}), preserve_index=False)


def _combine(ranges: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file in order: the state and depth in which each begins."""
    r = ranges.sort_values("start").to_dict("records")
    state, depth, base = OUT, 0, int(r[0]["first"] == b"[")
    whole = sum(x["size"] for x in r) == r[0]["total"]  # the file ends with a closing brace
    out = []
    for i, x in enumerate(r):
        out.append((x["file"], x["start"], state, depth, base, i == 0, i == len(r) - 1 and not whole))
        state, depth = x[f"e{state}"], depth + x[f"d{state}"]
    return pd.DataFrame(out, columns=["file", "start", "state", "depth", "base", "begins", "cut"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "start", "no", "text", "begins", "ends"]
    key, records, waiting, no = None, None, None, 0

    def flush(last: bool):
        nonlocal no
        if last:
            records.end()
        rows = [(key[0], key[1], no + i, *x) for i, x in enumerate(records.out)]
        no += len(rows)
        records.out = []
        return [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)] if rows else []

    for k, chunk in _chunks(batches, "state", "depth", "base", "begins", "cut"):
        if k != key:
            if key is not None:
                records.feed(waiting + (b"" if key[6] else b"}"))
                yield from flush(True)
            key, records, waiting, no = k, Records(*k[2:6]), None, 0
        if waiting is not None:
            records.feed(waiting + b"}")
            if len(records.out) >= 1000:
                yield from flush(False)
        waiting = chunk
    if key is not None:
        records.feed(waiting + (b"" if key[6] else b"}"))
        yield from flush(True)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of each record of the JSON files under ``path``, arrays of records or one value after the other.

    Every file is read in byte ranges (``spark.sql.files.maxPartitionBytes``), twice. A truncated array loses its
    last record only, which comes back with the text it has. A record's own faults stay in its text."""
    lines = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("total"), F.col("value").cast("binary").alias("chunk"))
    maps = stored(lines.mapInArrow(_scan, "file string, start long, total long, size long, first binary, e0 long, e1 long, e2 long, "
                                          "d0 long, d1 long, d2 long"), "array-ranges")
    begin = stored(maps.groupBy("file").applyInPandas(
        _combine, "file string, start long, state long, depth long, base long, begins boolean, cut boolean"), "array-states")
    if begin.limit(BROADCAST + 1).count() <= BROADCAST:
        both = lines.drop("total").join(F.broadcast(begin), ["file", "start"])
    else:  # the order of a range's chunks has to be restored
        both = (lines.drop("total").withColumn("row", F.monotonically_increasing_id()).join(begin, ["file", "start"])
                .repartition("file", "start").sortWithinPartitions("file", "start", "row").drop("row"))
    pieces = stored(both.mapInArrow(_cut, "file string, start long, no long, text binary, begins boolean, ends boolean"), "array-records")
    whole = pieces.where("begins AND ends").select(F.col("text").cast("string").alias("value"))
    # the others, a few a range, in the order of the file: a record goes on until the next one begins
    w = Window.partitionBy("file").orderBy("start", "no")
    split = pieces.where("NOT (begins AND ends)").withColumn("record", F.sum(F.col("begins").cast("long")).over(w))
    texts = split.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "no", F.col("text").cast("string").alias("text")))).alias("p"))
    return whole.unionByName(texts.select(F.array_join(F.col("p.text"), "").alias("value")))
