"""Exact top-k inner products by norm buckets."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.llm.common import column, written

BUCKET = 1024  # vectors in a bucket
QUERIES = 512  # queries in a block
SEED = 2048  # vectors of largest norm that give each query its first threshold
SMALL = 1 << 24  # components up to this are kept in 32 bits, with products in 64 bits
SAFE = 1e140  # norms up to which products are finite floats, so that they can prune
MOST = (1 << 63) - 1
GROUPS = 64  # of buckets; query blocks meet each group by an equi-join
COORDINATES = 8
COSINE = 0.5  # from this local threshold on, coordinates prune better than lengths
_PACKED = "block long, dim int, n int, top double, reach double, ids binary, vectors binary, theta binary"


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("over", pa.binary())])


def integers(vector, scale: int) -> list[int]:
    """floor(scale * x) of each component, exact also where that is no finite float."""
    return [math.floor(y) if math.isfinite(y := x * scale) else int(x) * scale for x in vector]


def quantise(vectors: list, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(positions, vectors) of the vectors that take part: integers of 32 bits, or the unscaled components as floats
    where those are too few."""
    at, out = [], []
    for i, v in enumerate(vectors):
        if v is None or any(x is None for x in v):
            continue
        x = np.asarray(v, dtype=np.float64)
        if np.isfinite(x).all():
            with np.errstate(over="ignore"):
                q = np.floor(x * scale)
            at.append(i)
            out.append(q.astype("<i4") if (np.abs(q) <= SMALL).all() else x.astype("<f8"))
    return np.array(at, dtype=np.int64), out


def _norm(v: np.ndarray, scale: int) -> float:
    if v.dtype == np.dtype("<i4"):
        return float(np.sqrt(np.dot(v.astype(float), v.astype(float))))
    big = float(np.abs(v).max())
    return float(big * np.sqrt(np.sum((v / big) ** 2))) * scale


def _rows(raw: bytes, n: int, dim: int) -> np.ndarray:
    """Packed vectors: 32-bit integers, or floats if they take twice the room."""
    if not dim:
        return np.zeros((n, 0), "<i4")
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * n * dim else "<f8").reshape(n, dim)


def _quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, q = quantise(column(b, "v").to_pylist(), scale)
            with np.errstate(over="ignore"):
                norms = [_norm(x, scale) for x in q]
            yield pa.RecordBatch.from_arrays(
                [column(b, "id").take(pa.array(at)), pa.array([len(x) for x in q], pa.int32()),
                 pa.array(norms, pa.float64()), pa.array([x.tobytes() for x in q], pa.binary())], names=["id", "dim", "norm", "v"])

    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id IS NOT NULL")
            .mapInArrow(run, "id long, dim int, norm double, v binary"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int, theta: bool) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one dimension, packed by ``size`` into one row each."""
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("top", pa.float64()),
                        ("reach", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("theta", pa.binary())])
    part, count, held = TaskContext.get().partitionId(), 0, []

    def pack(rows):
        t = np.array([r["theta"] for r in rows]).tobytes() if theta else None
        return pa.RecordBatch.from_pylist([{
            "block": (part << 32) + count, "dim": rows[0]["dim"], "n": len(rows),
            "top": max(r["norm"] for r in rows),
            "reach": min((r["theta"] / r["norm"] if 0 < r["norm"] <= SAFE else -np.inf for r in rows)) if theta else None,
            "ids": np.array([r["id"] for r in rows], "<i8").tobytes(),
            "vectors": b"".join(r["v"] for r in rows), "theta": t}], schema=schema)

    for b in batches:
        for r in b.to_pylist():
            if held and (len(held) >= size or held[-1]["dim"] != r["dim"] or len(held[-1]["v"]) != len(r["v"])):
                yield pack(held)
                count, held = count + 1, []
            held.append(r)
    if held:
        yield pack(held)


def search(q: np.ndarray, theta: np.ndarray, q_ids: np.ndarray, v: np.ndarray, v_ids: np.ndarray,
           k: int) -> pd.DataFrame:
    """The k best (score, then smaller id) of one bucket for each query, of those that reach the query's
    threshold. ``v`` is sorted by falling norm. The local cosine threshold, theta / (query norm x largest
    norm), says how to prune: above 1 the bucket holds nothing; from ``COSINE`` on, the products over the
    query's largest coordinates plus the norms of the rest bound each vector; below, only vectors at least
    theta / query norm long are tried. What is left is verified by whole integer products."""
    vf = v.astype(np.float64)
    norms = np.sqrt((vf * vf).sum(axis=1))
    found: list[tuple[int, int, int]] = []
    for i in range(len(q)):
        qf = q[i].astype(np.float64)
        length = float(np.sqrt(qf @ qf))
        need = theta[i]
        at = np.arange(len(v))
        if need > 0:
            slack = 1e-9 * (abs(need) + 1) + 1e-9 * length * float(norms[0])
            if length * norms[0] + slack < need:
                continue
            if need >= COSINE * length * norms[0] and len(qf) > COORDINATES:
                f = np.argpartition(-np.abs(qf), COORDINATES)[:COORDINATES]
                vs = vf[:, f]
                rest_q = max(0.0, length * length - float(qf[f] @ qf[f])) ** 0.5
                rest_v = np.sqrt(np.maximum(0.0, norms * norms - (vs * vs).sum(axis=1)))
                at = np.nonzero(vs @ qf[f] + rest_q * rest_v + slack + 1e-6 * length * norms[0] >= need)[0]
            else:
                at = at[: int(np.searchsorted(-norms, -(need - slack) / length, side="right"))] if length else at
        score = v[at] @ q[i]
        ok = (score >= need) & (v_ids[at] != q_ids[i])
        at, score = at[ok], score[ok]
        if len(at) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            near = score >= cut
            at, score = at[near], score[near]
        order = np.lexsort((v_ids[at], -score))[:k]
        found += [(int(q_ids[i]), int(v_ids[at[o]]), int(score[o])) for o in order]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def search_large(q: list[list[int]], theta: np.ndarray, q_ids: np.ndarray, v: list[list[int]], v_ids: np.ndarray, k: int) -> list[tuple]:
    """``search`` where products need not fit in 64 bits: every candidate of the bucket, in whole numbers of any size."""
    found = []
    ids = v_ids.tolist()
    for own, need, one in zip(q_ids.tolist(), theta.tolist(), q, strict=True):
        s = [(-x, j) for w, j in zip(v, ids, strict=True)
             if j != own and ((x := sum(a * b for a, b in zip(one, w, strict=True))) >= need)]
        found += [(own, j, -x) for x, j in heapq.nsmallest(k, s)]
    return found


def _over(score: int) -> bytes | None:
    """For scores that a long can't hold, or just can: bytes that sort as they do."""
    if -MOST < score < MOST:
        return None
    raw = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    raw = len(raw).to_bytes(4, "big") + raw
    return raw if score > 0 else bytes(255 - x for x in raw)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """Exact maximum inner products: for each row whose id is divisible by ``every``, its ``k`` best
    partners among all other rows: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x), x as double; scores are integer products, ties go to the smaller
    id. Vectors that are null or hold null or non-finite components take no part, nor do rows without an
    id. Components beyond 2**24 after scaling are kept as floats and multiplied as whole numbers of any size; a score
    that a long can't hold is ranked by its true value and shown as the nearest long. Vectors meet those of their own dimension only.
    Rows that repeat an id are candidates each; a query's own id is never its partner, and a repeated
    query id counts once (the row with the smallest vector bytes). Other columns are not read.

    Vectors are sorted by (dimension, norm, id) into buckets of ``BUCKET``, so that equal vectors, however
    many, spread over buckets. Products with the ``SEED`` longest vectors (a fixed number, broadcast) give
    each query its first threshold. Query blocks are joined by bucket number to those buckets that the
    threshold leaves, as packed rows of bounded size; ``search`` prunes inside.
    """
    v = written(_quantised(vectors, id_col, vec_col, scale), "topk-v")
    spark = v.sparkSession
    ordered = v.repartitionByRange(F.col("dim"), F.col("norm").desc(), F.col("id")).sortWithinPartitions(
        F.col("dim"), F.col("norm").desc(), F.col("id"))
    buckets = written(ordered.mapInArrow(lambda b: _blocks(b, BUCKET, False), _PACKED), "topk-b")

    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    small = F.length("v") == 4 * F.col("dim")
    rows = v.where(small).orderBy(F.col("norm").desc(), "id").limit(SEED).toArrow().to_pandas()
    for d, g in rows.groupby("dim"):
        seeds[int(d)] = (g["id"].to_numpy(), _rows(b"".join(g["v"]), len(g), int(d)).astype(np.int64))
    shared = spark.sparkContext.broadcast(seeds)

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                ids, m = shared.value.get(r["dim"], (None, None))
                theta, q = -np.inf, _rows(r["v"], 1, r["dim"])[0]
                if ids is not None and r["norm"] <= SAFE:  # a large query's products are floats, less what rounding can add
                    large = q.dtype != np.dtype("<i4")
                    s = (m @ (q * scale if large else q.astype(np.int64)))[ids != r["id"]]
                    if len(s) >= k:
                        theta = float(np.partition(s, len(s) - k)[len(s) - k])
                        theta -= large * (1e-9 * r["norm"] + len(q)) * float(np.sqrt((m.astype(float) ** 2).sum(axis=1)).max())
                out.append(theta)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, "theta"])

    queries = v.where(F.col("id") % every == 0).groupBy("id").agg(F.min_by(F.struct("dim", "norm", "v"), "v").alias("r"))
    queries = queries.select("id", "r.dim", "r.norm", "r.v").mapInArrow(
        thresholds, "id long, dim int, norm double, v binary, theta double")
    # queries that reach as far down the buckets stand together
    near = F.try_divide("theta", "norm")
    queries = queries.repartitionByRange(F.col("dim"), near, F.col("id")).sortWithinPartitions(F.col("dim"), near, F.col("id"))
    blocks = written(queries.mapInArrow(lambda b: _blocks(b, QUERIES, True), _PACKED), "topk-q")

    # for each bucket, the query blocks whose thresholds its longest vector can reach
    reach = buckets.select("dim", F.pmod(F.xxhash64("block"), F.lit(GROUPS)).alias("g"), "block", F.col("top").alias("btop"))
    far = blocks.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GROUPS - 1).cast("long"))).alias("g"),
                        F.col("block").alias("q"), "reach")
    pairs = far.join(reach, ["dim", "g"]).where("btop * 1.000001 >= reach").select("q", "block")
    pairs = (pairs.join(blocks.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_v"),
                                      "theta"), "q")
             .join(buckets.select("block", "dim", "ids", "vectors"), "block")
             .select("dim", "q_ids", "q_v", "theta", "ids", "vectors"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = np.dtype("<i4")
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                ids, q_ids, theta = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["theta"])
                m, q = _rows(r["vectors"], len(ids), r["dim"]), _rows(r["q_v"], len(q_ids), r["dim"])
                if m.dtype == q.dtype == small:
                    out = search(q.astype(np.int64), theta, q_ids, m.astype(np.int64), ids, k)
                    out["over"] = None
                else:
                    whole = lambda x: x.tolist() if x.dtype == small else [integers(y, scale) for y in x.tolist()]
                    rows = search_large(whole(q), theta, q_ids, whole(m), ids, k)
                    out = pd.DataFrame([(a, j, max(-MOST - 1, min(MOST, x)), _over(x)) for a, j, x in rows],
                                       columns=["query_id", "vec_id", "score", "over"])
                yield pa.RecordBatch.from_pandas(out, schema=_FOUND, preserve_index=False)

    found = pairs.mapInArrow(products, "query_id long, vec_id long, score long, over binary")
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("over").desc_nulls_last(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
