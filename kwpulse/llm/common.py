"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.session import checkpoint_dir, configure

AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts its lineage, and a lost
    executor costs only the tasks that read it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class WordHash(dict):
    """64-bit hash of a word (bytes); remembers the words seen, up to a bound."""

    LIMIT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = h
        return h


_hashes = WordHash()


def hash_words(words: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each word."""
    return np.fromiter(map(_hashes.__getitem__, words), U64, len(words))


def mix(a: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit (wraps modulo 2**64)."""
    a = (a ^ (a >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> U64(27))) * U64(0x94D049BB133111EB)
    return a ^ (a >> U64(31))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word sequences in a sequence of word hashes (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = mix(h[:n] + U64(k))
    for i in range(1, k):
        out = mix(out * U64(0x9E3779B97F4A7C15) + h[i:i + n])
    return out


def slices(batches: Iterator[pa.RecordBatch], col: str | Callable, max_bytes: int = 8 << 20,
           max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column (its name, or a function of the batch) of each has about ``max_bytes`` at most
    (a single row may be longer): tasks hold only one slice of long texts at a time."""
    for b in batches:
        texts = col(b) if callable(col) else column(b, col)
        sizes = np.array(pc.fill_null(pc.binary_length(texts), 0))
        start, total = 0, 0
        for i, s in enumerate(sizes.tolist()):
            if i > start and (total + s > max_bytes or i - start >= max_rows):
                yield b.slice(start, i - start)
                start, total = i, 0
            total += s
        if start < b.num_rows:
            yield b.slice(start)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def lower_ascii(c):
    """A-Z to a-z, all else unchanged."""
    return F.translate(c, AZ, az)


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: columns ``u, v`` (comparable, not null). Returns one row per node of an edge,
    ``node, component`` with the smallest node of its component. DataFrame operations only; each
    round is written to the shared folder. Hub nodes are reduced by map-side minima; the joins that
    send the minimum back are ordinary joins, which adaptive execution splits at hot keys. Stops
    when a round changes nothing, which the two order-independent sums show.
    """
    def edges_of(df):
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df):
        r = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                   F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))).first()
        return tuple(r)

    cur = written(edges_of(edges), f"{name}-cc")
    before = state(cur)
    for _ in range(rounds):
        if before[0] == 0:
            break
        # large star: every neighbour above u goes to the least of u's neighbourhood
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: the neighbours below u, and u itself, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        cur = written(edges_of(small), f"{name}-cc")
        after = state(cur)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
