"""Benchmark decontamination: a prefix-filtered join of item windows with documents by their rarest shingle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.llm.common import U64, column, grams, hash_words, slices, written

WINDOW = 10  # words
SHINGLE = 3  # words; shorter windows use their whole length
BITS = 26  # of a shingle's hash that index the bit table: 8 MB, whatever the benchmark's size
BUCKET = 1 << 15  # bits of a bitmap of Spark's
BATCH = 8192  # rows that a task emits at a time
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 32_000_000

# A-Z become a-z; ASCII other than letters and digits separates words; bytes of other characters stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``item, w, n, k, hs``: every window of every item, its words joined by blanks, their number, the size of its
    shingles and their hashes in order. One row per occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            for item, t in zip(column(b, "i").to_pylist(), column(b, "t").to_pylist(), strict=True):
                w = words(t)
                n = min(window, len(w))
                k = min(SHINGLE, n)
                g = grams(hash_words(w), k).view(np.int64) if w else None
                for lo in range(0, len(w) - n + 1 if w else 0, BATCH):
                    at = range(lo, min(lo + BATCH, len(w) - n + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(at)), pa.array([b" ".join(w[s:s + n]).decode("utf-8", "surrogatepass") for s in at]),
                         pa.array([n] * len(at), pa.int32()), pa.array([k] * len(at), pa.int32()),
                         pa.array([g[s:s + n - k + 1] for s in at], pa.list_(pa.int64()))], names=["item", "w", "n", "k", "hs"])

    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t"))
    return rows.where("i IS NOT NULL AND t IS NOT NULL").distinct().mapInArrow(
        run, "item string, w string, n int, k int, hs array<long>")


class Filter:
    """A bit table of shingle hashes, of one size for any number of them: what is not in it is in no window, and what is
    meets the windows by a join. ``sizes`` are the sizes of the shingles, ``window`` bounds the words around one."""

    def __init__(self, hashes: DataFrame, sizes: list[int], window: int):
        bit = (F.col("h").bitwiseAND(F.lit((1 << BITS) - 1)) + 1).alias("x")
        maps = hashes.select(bit).groupBy(F.bitmap_bucket_number("x").alias("b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
        self.table = np.zeros((1 << BITS) // 8, np.uint8)
        for r in maps.collect():  # 2048 rows of 4 KB at most; an iterator would run a job for every shuffle partition
            self.table[(r["b"] - 1) * BUCKET // 8:r["b"] * BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
        self.sizes, self.window, self.bits = sizes, window, 1 << BITS

    def lookup(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size: (size, positions, hashes) of a document's shingles in the table."""
        for k in self.sizes:
            g = grams(h, k)
            x = (g & U64(self.bits - 1)).astype(np.int64)
            at = np.nonzero(self.table[x >> 3] >> (x & 7).astype(np.uint8) & 1)[0]
            if len(at):
                yield k, at, g[at].view(np.int64)


def _counts(texts: DataFrame, shared) -> DataFrame:
    """``k, h, c``: occurrences in the documents (column ``t``) of the shingles in the filter, summed by slice, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            by: dict[int, list[np.ndarray]] = {}
            for t in column(b, "t").to_pylist():
                for k, _, h in shared.value.lookup(hash_words(words(t))):
                    by.setdefault(k, []).append(h)
            for k, parts in by.items():
                h, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h), pa.array(n.astype(np.int64))],
                                                 names=["k", "h", "n"])

    return texts.mapInArrow(run, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("c"))


_CANDIDATE = {"p": pa.int64(), "k": pa.int32(), "h": pa.int64(), "off": pa.int32(), "around": pa.string()}


def _scan(rows: DataFrame, id_type: str, shared) -> DataFrame:
    """``rid, id, key, t`` -> a row per document (``rid, id, key, n_words``) and one per shingle in the filter (``rid``, its place
    ``p``, size and hash, and the words ``around`` it, of which ``off`` stand before it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "id", "key", "n_words", *_CANDIDATE]
        for b in slices(batches, "t"):
            id_type, n_words, out = column(b, "id").type, [], []

            def flush(out=out, id_type=id_type):
                n, cols = len(out), list(zip(*out, strict=True))
                batch = pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                     *[pa.array(c, t) for c, t in zip(cols[1:], _CANDIDATE.values(), strict=True)]], names=names)
                out.clear()
                return batch

            f = shared.value
            for rid, t in zip(column(b, "rid").to_pylist(), column(b, "t").to_pylist(), strict=True):
                w = words(t)
                n_words.append(len(w))
                for k, at, h in f.lookup(hash_words(w)):
                    for p, x in zip(at.tolist(), h.tolist(), strict=True):
                        lo = max(0, p - f.window + k)
                        out.append((rid, p, k, x, p - lo, b" ".join(w[lo:p + f.window]).decode("utf-8", "surrogatepass")))
                        if len(out) >= BATCH:
                            yield flush()
            if out:
                yield flush()
            yield pa.RecordBatch.from_arrays(
                [column(b, "rid"), column(b, "id"), column(b, "key"), pa.array(n_words, pa.int64()),
                 *[pa.nulls(b.num_rows, t) for t in _CANDIDATE.values()]], names=names)

    return rows.mapInArrow(run, f"rid long, id {id_type}, key long, n_words long, p long, k int, h long, off int, around string")


def _hinted(df: DataFrame, chars: str | None = None) -> DataFrame:
    """Broadcast a written frame if it is counted to be small, by its rows and the length of a column."""
    n, total = df.agg(F.count(F.lit(1)), F.sum(F.length(chars)) if chars else F.lit(0)).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (total or 0) <= BROADCAST_CHARS else df


def _occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
                 window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (``rid, id, key, n_words``), the verified occurrences of windows in them (``rid, start, n, wid``) and
    the windows' owners (``wid, item``)."""
    sc = docs.sparkSession.sparkContext
    text = F.col(f"`{text_col}`")
    found = written(windows(benchmark, item_col, item_text_col, window).withColumn("wid", F.unhex(F.md5("w"))), "decontam-windows")
    options = found.select("wid", "w", "n", "k", "hs").distinct().select("wid", "w", "n", "k", F.posexplode("hs").alias("place", "h"))
    sizes = sorted(r["k"] for r in found.select("k").distinct().collect())  # SHINGLE of them at most
    count = _counts(docs.select(text.alias("t")), sc.broadcast(Filter(found.select(F.explode("hs").alias("h")), sizes, window)))
    # a window is in a document only if all its shingles are: one that no document holds rules it out
    prefix = options.join(count, ["k", "h"], "left").groupBy("wid", "w", "n", "k").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0).cast("long")).alias("c"), "h", "place")).alias("m")).where("m.c > 0")
    prefix = written(prefix.select("k", "m.h", "wid", "w", "n", "m.place"), "decontam-prefixes")

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"),
                       text.alias("t"))
    scan = written(_scan(rows, docs.select(F.col(f"`{id_col}`").alias("id")).dtypes[0][1],
                         sc.broadcast(Filter(prefix.select("h"), sizes, window))), "decontam-scan")
    met = scan.where("p IS NOT NULL").select("rid", "p", "k", "h", "off", "around").join(_hinted(prefix, "w"), ["k", "h"])
    # position and length bounds, then the words themselves
    fits = (F.expr("off >= place") & F.expr("off - place + n <= size(split(around, ' '))")
            & F.expr("array_join(slice(split(around, ' '), off - place + 1, n), ' ') = w"))
    occ = written(met.where(fits).select("rid", F.expr("p - place").alias("start"), "n", "wid"), "decontam-occurrences")
    return scan.where("p IS NULL").select("rid", "id", "key", "n_words"), occ, found.select("wid", "item").distinct()


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, keep_clean: bool = False) -> DataFrame:
    """Find the benchmark's windows in whole documents.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. Returns one row per input row: id, ``n_words``, ``n_hit`` (words inside any occurrence of a
    window), ``items`` (sorted ids, as strings, of the items with occurring windows), ``n_items``,
    ``items_sha256`` (of the ids, comma-joined) and ``contaminated`` (``n_hit`` > 0). With ``keep_clean``
    it returns instead the input rows without a hit, with all their columns.

    Null texts have no words; items without id, text or words have no windows; an item id with several
    rows owns the windows of all. An empty benchmark hits nothing. Repeated rows are marked each; other
    columns are not read (but for ``keep_clean``).

    The windows are a frame of their own. One pass over the documents counts the windows' shingles, which gives each window its
    rarest as its prefix (for containment, one token; ties: smaller hash, then first place); a second one emits the documents'
    prefix shingles with the words around them, which are joined with the windows and verified. Both passes leave out what a
    bit table of fixed size shows to be no shingle of a window. Whole texts are never shuffled; the rows of ``keep_clean`` are if more
    than ``BROADCAST_ROWS`` documents are hit.
    """
    rows, occ, owners = _occurrences(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
    if keep_clean:
        # a document is an id and a text
        gone = written(rows.join(occ.select("rid").distinct(), "rid", "left_semi").select("id", "key").distinct(), "decontam-hit")
        d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        same = d[f"row.`{id_col}`"].eqNullSafe(gone["id"]) & (F.xxhash64(d[f"row.`{text_col}`"]) == gone["key"])
        return d.join(_hinted(gone), same, "left_anti").select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])

    hit = occ.select("rid", F.explode(F.expr("sequence(start, start + n - 1)")).alias("at")).groupBy("rid").agg(
        F.count_distinct("at").alias("n_hit"))
    items = (occ.select("rid", "wid").distinct().join(owners, "wid").select("rid", "item").distinct()
             .groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items")))
    out = rows.join(hit.join(items, "rid"), "rid", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "items",
                      F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"))
