"""Conversation prefix trie: member intervals of every shared prefix by range minima over sorted LCPs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.llm.common import U64, column, written

DIGEST = 16  # bytes that stand for a turn
BLOCK_ROWS = 8192  # conversations of a block
BLOCK_TURNS = 65_536  # turns of a block; a longer conversation is a block of its own
MOST_HEAD = 5  # turns that a conversation can take over
BROADCAST = 200_000
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_BLOCK = "part int, block long, first int, final int, ids binary, turns binary, keys binary, sizes binary, before binary, after binary"
_PARTS = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string, key binary, parent binary, part int, block long, ends string, n_ends long")


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order (null turn first, ties by their digests), as structs of a
    hexadecimal digest of role and text and the text's length. The texts stay where they are read."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("size"))
    rows = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, sizes``: conversation c as the first h turns of conversation c - c % 100 and its own turns after
    its first h, h = crc32(c in decimal) % 6. ``key`` holds 16 bytes for each turn, ``sizes`` the lengths of the texts."""
    own = written(sequences(conversations), "trie-turns")
    heads = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_HEAD).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (MOST_HEAD + 1)).cast("int")
    both = own.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left")
    none = F.slice("turns", 1, F.lit(0))
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                     F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return both.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"), F.col("turns.size").alias("sizes"))


def _blocks(batches: Iterator[pa.RecordBatch], most_rows: int, most_turns: int) -> Iterator[pa.RecordBatch]:
    """A sorted partition as packed blocks of bounded size. Each knows the last key before it and the first after it, but
    at the ends of the partition."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("first", pa.int32()), ("final", pa.int32()), *((c, pa.binary()) for c in (
        "ids", "turns", "keys", "sizes", "before", "after"))])
    part, block, before, held, turns = TaskContext.get().partitionId(), 0, None, [], 0

    def pack(after):
        n = np.array([len(k) // DIGEST for _, k, _ in held], "<i8")
        return pa.RecordBatch.from_pylist([{
            "part": part, "block": block, "first": n[0], "final": n[-1], "ids": np.array([i for i, _, _ in held], "<i8").tobytes(),
            "turns": n.tobytes(), "keys": b"".join(k for _, k, _ in held),
            "sizes": b"".join(np.array(s, "<i8").tobytes() for _, _, s in held), "before": before, "after": after}], schema=schema)

    for b in batches:
        for at in range(0, b.num_rows, 1024):
            s = b.slice(at, 1024)
            for row in zip(*(column(s, c).to_pylist() for c in ("conv_id", "key", "sizes")), strict=True):
                if held and (len(held) >= most_rows or turns + len(row[2]) > most_turns):
                    yield pack(row[1])
                    block, before, held, turns = block + 1, held[-1][1], [], 0
                held.append(row)
                turns += len(row[2])
    if held:
        yield pack(None)


def common(a: bytes, b: bytes) -> int:
    """The number of first turns that two keys share."""
    n = min(len(a), len(b)) // DIGEST
    x, y = (np.frombuffer(k, U64, 2 * n).reshape(n, 2) for k in (a, b))
    off = np.nonzero((x != y).any(axis=1))[0]
    return int(off[0]) if len(off) else n


class Minima:
    """A sparse table: level j holds the least value of every 2**j neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            a, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(a[:-step], a[step:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least of values[lo..hi] (inclusive, lo <= hi), for whole arrays of ranges."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for j in np.unique(level).tolist():
            at, a = np.nonzero(level == j)[0], self.levels[j]
            out[at] = np.minimum(a[lo[at]], a[hi[at] - (1 << j) + 1])
        return out


def neighbours_share(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each row of sorted keys (``keys``: all turns, two words each; ``n``: turns by row) the turns it shares with
    the row before; 0 for the first."""
    first = np.cumsum(n) - n
    both = np.minimum(n[1:], n[:-1])
    out = np.zeros(len(n), np.int64)
    if both.sum():
        k = np.arange(int(both.sum())) - np.repeat(np.cumsum(both) - both, both)
        row = np.repeat(np.arange(1, len(n)), both)
        same = (keys[first[row] + k] == keys[first[row - 1] + k]).all(axis=1)
        stop = np.where(same, both[row - 1], k)  # the place of the first difference
        some = np.nonzero(both)[0]
        out[some + 1] = np.minimum.reduceat(stop, (np.cumsum(both) - both)[some])
    return out


def extents(least: Minima, at: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows around ``at`` that share its first ``depth`` turns: both ends by binary search of their own over the
    range minima of the LCPs (value i: rows i - 1 and i)."""
    lo, left = np.zeros(len(at), np.int64), at.copy()  # the least l with LCP >= depth on l + 1..at
    while (go := np.nonzero(lo < left)[0]).size:
        mid = (lo[go] + left[go]) // 2
        ok = least.least(mid + 1, at[go]) >= depth[go]
        left[go] = np.where(ok, mid, left[go])
        lo[go] = np.where(ok, lo[go], mid + 1)
    right, hi = at.copy(), np.full(len(at), n - 1)  # the greatest r with LCP >= depth on at + 1..r
    while (go := np.nonzero(right < hi)[0]).size:
        mid = (right[go] + hi[go] + 1) // 2
        ok = least.least(at[go] + 1, mid) >= depth[go]
        right[go] = np.where(ok, mid, right[go])
        hi[go] = np.where(ok, hi[go], mid - 1)
    return left, right


def nodes_of(block: dict) -> dict[str, list]:
    """The nodes of one block of sorted conversations. Those that reach over its ends are parts, with their keys."""
    ids, n = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["turns"], "<i8")
    sizes, raw, rows = np.frombuffer(block["sizes"], "<i8"), block["keys"], len(ids)
    keys = np.frombuffer(raw, U64).reshape(-1, 2)
    first = np.cumsum(n) - n
    key = lambda i, d=None: raw[first[i] * DIGEST:(first[i] + (n[i] if d is None else d)) * DIGEST]
    shared = neighbours_share(keys, n)
    if block["before"] is not None:
        shared[0] = common(block["before"], key(0))
    into = -1 if block["before"] is None else int(shared[0])  # nodes up to this depth go on from the block before
    onto = -1 if block["after"] is None else common(key(rows - 1), block["after"])
    table = Minima(shared)
    # a leaf ends where the next conversation does not begin with it
    leaf = n > np.append(shared[1:], onto)
    leaves = np.append(0, np.cumsum(leaf))
    least_id = Minima(ids)
    # text lengths: of a whole conversation, of the turns it adds to the sorted ones before it, of its first d turns
    total = np.append(0, np.cumsum(sizes))
    whole = total[first + n] - total[first]
    fresh = whole - (total[first + shared] - total[first])
    whole_sum, fresh_sum = np.append(0, np.cumsum(whole)), np.append(0, np.cumsum(fresh))

    # a candidate for each conversation and depth; each interval speaks through its first conversation
    at = np.repeat(np.arange(rows), n + 1)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
    left, right = extents(table, at, depth, rows)
    one = at == left
    left, right, depth = left[one], right[one], depth[one]
    opens = ((left == 0) & (depth <= into)) | ((right == rows - 1) & (depth <= onto))
    begins = (left > 0) | (depth > into)  # the node's first conversation is here

    above = total[first[left] + np.maximum(depth - 1, 0)] - total[first[left]]  # length before the node's own text
    members = right - left + 1
    new = fresh_sum[right + 1] - fresh_sum[left]
    new += np.where(begins, whole[left] - above - fresh[left], 0)
    saved = whole_sum[right + 1] - whole_sum[left] - members * above - new
    # a child begins at each row that leaves the row before it at this depth
    order = np.sort((shared * (rows + 1) + np.arange(rows))[n > shared])
    from_row = left + begins
    child = np.searchsorted(order, depth * (rows + 1) + right, "right") - np.searchsorted(order, depth * (rows + 1) + from_row, "left")
    child += begins & (n[left] > depth)
    # equal conversations are sorted by id and stand first: the node's ends
    breaks = np.append(np.nonzero((n[1:] != shared[1:]) | (n[1:] != n[:-1]))[0] + 1, rows)  # rows that differ from the one before
    stop = breaks[np.searchsorted(breaks, left, "right")]
    n_ends = np.where(n[left] == depth, np.minimum(stop, right + 1) - left, 0)
    text = [str(i) for i in ids.tolist()]
    ends = [",".join(text[i:i + k]) for i, k in zip(left.tolist(), n_ends.tolist(), strict=True)]

    # the parent: the node of one turn less around the same conversation; its interval by the same searches
    some = np.nonzero(depth > 0)[0]
    parent_id, parent_open = np.zeros(len(left), np.int64), np.zeros(len(left), bool)
    pl, pr = extents(table, left[some], depth[some] - 1, rows)
    parent_id[some] = least_id.least(pl, pr)
    parent_open[some] = ((pl == 0) & (depth[some] - 1 <= into)) | ((pr == rows - 1) & (depth[some] - 1 <= onto))
    digest = lambda i, d: hashlib.md5(key(i, d)).digest()
    o, l, d = opens.tolist(), left.tolist(), depth.tolist()
    return {
        "conv_id": least_id.least(left, right), "depth": depth,
        "parent_conv_id": [None if x == 0 or p else v for x, p, v in zip(d, parent_open.tolist(), parent_id.tolist(), strict=True)],
        "n_convs": members, "n_children": child, "n_leaves": leaves[right + 1] - leaves[left], "saved_tokens": saved,
        "ends_sha256": [None if x else hashlib.sha256(e.encode()).hexdigest() for x, e in zip(o, ends, strict=True)],
        "key": [digest(i, k) if x else None for x, i, k in zip(o, l, d, strict=True)],
        "parent": [digest(i, k - 1) if p else None for p, i, k in zip(parent_open.tolist(), l, d, strict=True)],
        "ends": [e if x else None for x, e in zip(o, ends, strict=True)], "n_ends": n_ends}


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"parent_conv_id": pa.int64(), "ends_sha256": pa.string(), "key": pa.binary(), "parent": pa.binary(), "ends": pa.string()}
    order = [x.split()[0] for x in _PARTS.split(", ")]
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            out = nodes_of(row)
            k = len(out["depth"])
            out |= {"part": pa.array([row["part"]] * k, pa.int32()), "block": pa.array([row["block"]] * k, pa.int64())}
            yield pa.RecordBatch.from_arrays([x if isinstance(x := out[c], pa.Array) else pa.array(x, types.get(c, pa.int64()))
                                              for c in order], names=order)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's pieces in their order, a piece at a time."""
    key, sha, empty = None, None, True
    names, out = ["key", "ends_sha256"], []
    for b in batches:
        for k, text in zip(column(b, "key").to_pylist(), column(b, "ends").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha, empty = k, hashlib.sha256(), True
            if text:
                sha.update(text.encode() if empty else b"," + text.encode())
                empty = False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)
            out = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], names=names)


def _few(df: DataFrame) -> DataFrame:
    """Broadcast a written frame if it is small enough, by count."""
    return F.broadcast(df) if df.limit(BROADCAST + 1).count() <= BROADCAST else df


def trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The prefix trie of the rebuilt conversations: a row for each distinct sequence of first turns, the root of depth 0
    included. Columns as ``NODE`` names them.

    ``conversations``: columns ``conv_id, turn, role, text`` (others are not read). Null roles and texts are empty, a null
    turn comes first, equal turns of a conversation are ordered by their digests, rows without ``conv_id`` take no part.
    An empty table has no root. Turns are known by 128 bits of their role and text.

    1. Turns become digests where they are read; a conversation is one row of 16 bytes a turn, without
       texts (the only unit kept together: a Spark row holds some 70 million turns). 2. Rows are range-partitioned by
       (key, id), so that equal conversations, however many, spread over tasks, and packed into blocks. 3. In a
       block, a sparse table over the LCPs of neighbours answers range minima; every conversation's every
       prefix searches the two ends of its member interval by bisection, and sums over intervals give a node's
       figures. 4. Only nodes that reach over a block's end are shuffled: their parts are summed by key. The ids
       that end at such a node are hashed as pieces in order, a piece at a time.
    """
    rows = written(rebuilt(conversations), "trie-rows")
    blocks = written(rows.repartitionByRange(F.col("key"), F.col("conv_id")).sortWithinPartitions("key", "conv_id")
                     .mapInArrow(lambda b: _blocks(b, block_rows, block_turns), _BLOCK), "trie-blocks")
    # the keys at the ends of neighbouring partitions: a row for each partition
    first, final = F.col("first") * DIGEST, F.col("final") * DIGEST
    ends = blocks.select("part", "block", F.substr("keys", F.lit(1), first).alias("head"),
                         F.substr("keys", F.length("keys") - final + 1, final).alias("tail"))
    edge = ends.groupBy("part").agg(F.min_by("head", "block").alias("head"), F.max_by("tail", "block").alias("tail"),
                                    F.max("block").alias("top"))
    w = Window.orderBy("part")  # of these few rows
    edge = written(edge.select("part", "top", F.lag("tail").over(w).alias("prior"), F.lead("head").over(w).alias("next")), "trie-ends")
    full = blocks.join(F.broadcast(edge), "part").withColumn(
        "before", F.when(F.col("block") == 0, F.col("prior")).otherwise(F.col("before"))).withColumn(
        "after", F.when(F.col("block") == F.col("top"), F.col("next")).otherwise(F.col("after")))
    parts = written(full.select(*[x.split()[0] for x in _BLOCK.split(", ")]).mapInArrow(_nodes, _PARTS), "trie-parts")

    open_ = parts.where("key IS NOT NULL")
    pieces = (open_.where("n_ends > 0").select("key", "part", "block", "ends").repartition("key")
              .sortWithinPartitions("key", "part", "block"))
    hashed = pieces.mapInArrow(_digests, "key binary, ends_sha256 string")
    sums = open_.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    merged = written(sums.join(hashed, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))), "trie-merged")
    parent_of = _few(merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("merged_parent")))
    cols = [x.split()[0] for x in NODE.split(", ")]
    own = [c for c in cols if c != "parent_conv_id"]
    both = parts.where("key IS NULL").select(*cols, "parent").unionByName(
        merged.select(*own, F.lit(None).cast("long").alias("parent_conv_id"), "parent"))
    return (both.join(parent_of, "parent", "left")
            .withColumn("parent_conv_id", F.coalesce("merged_parent", "parent_conv_id")).select(*cols))
