"""Exact n-gram Jaccard join of documents, and the groups its links make.

Jaccard distance is a metric; what follows from that (pivots, Voronoi regions, windows) splits crowds
of similar documents. Before it, an exact filter finds which documents can be similar to any other at
all: unrelated texts are all at distance 1 of each other, where no pivot can tell them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, exp, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwpulse.llm.common import U64, column, components, grams, hash_words, mix, slices, written

LEAF = 128  # documents that one task compares at once
FEW = 16  # members up to which groups are compared together
TILE = 64  # documents of a part of a region
PIVOTS = 16  # of a crowd, as expected number
MOST_PIVOTS = 24
HISTOGRAM = 64
LOCAL, FREQUENT = 4, 64  # occurrences of a shingle in a slice, and in all, from which it counts as frequent
MOST_FREQUENT = 500_000  # frequent shingles that travel with the tasks (which ones changes costs, never links)
BROADCAST = 200_000


class Bound:
    """Documents link if den * |intersection| >= num * |union|."""

    def __init__(self, num: int, den: int):
        if not 2 * den < 3 * num <= 3 * den:
            raise ValueError("similarities above 2/3 and up to 1 are supported")
        self.num, self.den = num, den
        lows = [1]  # size classes grow by half, so that sizes of linked documents are in the same or next class
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, ceil(lows[-1] * 1.5)))
        self.lows = np.array(lows, np.int64)
        self.parts: dict[int, tuple[int, int]] = {}

    @property
    def radius(self) -> float:
        return 1 - self.num / self.den

    def linked(self, inter, a, b):
        return self.den * inter >= self.num * (a + b - inter)

    def most_different(self, a, b):
        """The largest symmetric difference that linked sets of these sizes can have."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def classes(self, n: int) -> list[int]:
        """A set's own size class, and the one below if a linked set can be there."""
        c = int(np.searchsorted(self.lows, n, side="right")) - 1
        return [c, c - 1] if c and self.num * n <= self.den * int(self.lows[c] - 1) else [c]

    def split(self, c: int) -> tuple[int, int]:
        """(parts, spare) of a class: linked sets, the smaller of the class, agree wholly in more than
        ``spare`` of the parts into which hashing cuts the shingles."""
        if c not in self.parts:
            low, high = int(self.lows[c]), int(self.lows[c + 1]) - 1
            d, spare = high * (self.den - self.num) // self.num, 0
            for _ in range(20):
                m = d + 1 + spare
                empty = m * exp(-low / m)
                spare = min(d + 1, ceil(empty + 2 * sqrt(empty)))
            self.parts[c] = (d + 1 + spare, spare)
        return self.parts[c]


def words(text: str | None) -> list[bytes]:
    """Lower-cased A-Z, cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles; with fewer words, of the whole sequence."""
    h = hash_words(words(text))
    return np.unique(grams(h, min(k, len(h)))) if len(h) else h


def identity(s: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return np.array([mix(s ^ U64(0x243F6A8885A308D3)).sum(dtype=U64) + U64(len(s)),
                     mix(s ^ U64(0x13198A2E03707344)).sum(dtype=U64)], U64).tobytes()


def node(cls: bytes) -> int:
    return int(np.frombuffer(cls, "<i8", 1)[0])


def histogram(s: np.ndarray) -> bytes:
    """How many shingles fall into each of 64 hash ranges: the distance of two histograms is at most the
    symmetric difference of the sets."""
    return np.minimum(np.bincount((s >> U64(58)).astype(np.int64), minlength=HISTOGRAM), 65535).astype("<u2").tobytes()


def signatures(s: np.ndarray, bound: Bound, frequent: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, salts): linked sets share one, salts aside.

    Hashing cuts the shingles into parts, more than linked sets can differ in; a part's content is a
    signature. Parts without a rare shingle give none. If a set has more of those than the class spares,
    linked sets might agree in such parts only: it then also gives its prefix, the rarest shingles, so many
    that linked sets share one. Frequent shingles there carry a salt that deals them into groups
    of about a thousand; a salt of -1 marks all other signatures."""
    n = len(s)
    weak = np.zeros(n, dtype=bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        weak = frequent[at] == s
    strong_before = np.concatenate([[0], np.cumsum(~weak)])
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(s), dtype=U64)])
    out, prefix = [], False
    for c in bound.classes(n):
        m, spare = bound.split(c)
        part = ((s >> U64(32)) * U64(m)) >> U64(32)
        cut = np.searchsorted(part, np.arange(m + 1, dtype=U64))
        good = strong_before[cut[1:]] > strong_before[cut[:-1]]
        j = np.nonzero(good)[0]
        key = U64((c * 0x9E3779B97F4A7C15 + 0x51ED2701) & (2**64 - 1))
        out.append(mix(mix(sums[cut[1:]][j] - sums[cut[:-1]][j] + key) + j.astype(U64)))
        prefix |= m - len(j) > spare
    salts = [np.full(len(x), -1, np.int64) for x in out]
    if prefix:
        first = n - -(-bound.num * n // bound.den) + 1
        p = s[np.lexsort((s, weak))[:first]]
        out.append(mix(p ^ U64(0xA4093822299F31D0)))
        salt = np.full(len(p), -1, np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, p), len(frequent) - 1)
            hot = frequent[at] == p
            groups = count[at[hot]] // 1000 + 1
            salt[hot] = (int(sums[-1]) >> 8) % groups
        salts.append(salt)
    return np.concatenate(out).view(np.int64), np.concatenate(salts)


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges from each index to the least one of its component, given a symmetric matrix."""
    root = np.arange(len(linked))
    for i in range(len(linked)):
        own = np.unique(root[np.nonzero(linked[i, : i + 1])[0]])
        if len(own):
            root[np.isin(root, np.append(own, root[i]))] = min(int(own[0]), int(root[i]))
    return [(i, int(r)) for i, r in enumerate(root) if r != i]


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.concatenate([[True], flat[1:] != flat[:-1]])
    group = np.cumsum(starts) - 1
    many = np.bincount(group)[group] > 1
    owner, group = owner[many], group[many]
    total = np.zeros((len(sets), len(sets)))
    if len(group):
        group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
        for a in range(0, int(group[-1]) + 1, 4096):
            part = (group >= a) & (group < a + 4096)
            m = np.zeros((len(sets), 4096), np.float32)
            m[owner[part], group[part] - a] = 1
            total += m @ m.T
    return total


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """The groups of consecutive rows with equal keys of a sorted partition."""
    held: list[pd.DataFrame] = []
    last = None
    for b in batches:
        df = b.to_pandas()
        if not len(df):
            continue
        change = np.zeros(len(df), dtype=bool)
        for k in keys:
            v = df[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        for part in np.split(np.arange(len(df)), np.nonzero(change)[0]):
            g = df.iloc[part[0]:part[-1] + 1]
            key = tuple(g[k].iloc[0] for k in keys)
            if held and key != last:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(g)
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (sig, node, n, histograms) of a partition sorted by sig; a group is never cut, it waits for its last row."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        raw = b"".join(column(b, "histogram").to_pylist())
        part = [*(np.asarray(column(b, c)) for c in ("sig", "node", "n")), np.frombuffer(raw, "<u2").reshape(b.num_rows, HISTOGRAM).astype(np.int32)]
        if held is not None:
            part = [np.concatenate(x) for x in zip(held, part, strict=True)]
        cut = int(np.searchsorted(part[0], part[0][-1]))
        held = [x[cut:] for x in part]
        if cut:
            yield tuple(x[:cut] for x in part)
    if held is not None:
        yield tuple(held)


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())],
                                      names=["u", "v"])


def _few(df: DataFrame) -> DataFrame:
    """Broadcast a written frame if it is small enough, by count."""
    return F.broadcast(df) if df.limit(BROADCAST + 1).count() <= BROADCAST else df


def _scan(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """One row per document (id, th, n, cls, node, histogram), and the frequent shingles with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [shingles(t, k) for t in column(b, "text").to_pylist()]
            cls = [identity(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [column(b, "id"), column(b, "th"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()),
                 pa.array([node(c) for c in cls], pa.int64()), pa.array([histogram(s) for s in sets], pa.binary()),
                 pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.int64())], names=names)
            once = list(dict(zip(cls, sets, strict=True)).values())
            h, c = np.unique(np.concatenate(once), return_counts=True)
            h, c = h[c >= LOCAL], c[c >= LOCAL]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(h), b.schema.field("id").type), *(pa.nulls(len(h), t) for t in (
                    pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())),
                 pa.array(h.view(np.int64)), pa.array(c, pa.int64())], names=names)

    names = ["id", "th", "n", "cls", "node", "histogram", "h", "c"]
    kind = dict(docs.dtypes)["id"]
    both = written(docs.mapInArrow(run, f"id {kind}, th long, n long, cls binary, node long, histogram binary, h long, c long"),
                   "jaccard-scan")
    often = (both.where("h IS NOT NULL").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
             .orderBy(F.col("c").desc(), "h").limit(MOST_FREQUENT).toArrow())
    h, c = (np.asarray(often[x].to_numpy()) for x in ("h", "c"))
    h = h.astype(np.int64).view(U64)
    order = np.argsort(h)
    return both.where("cls IS NOT NULL").drop("h", "c"), h[order], c.astype(np.int64)[order]


def _neighbours(docs: DataFrame, scan: DataFrame, frequent, k: int, bound: Bound) -> DataFrame:
    """``node, component``: documents in different components can't link."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            seen: set[bytes] = set()
            sig, salt, own = [], [], []
            for t in column(b, "text").to_pylist():
                s = shingles(t, k)
                c = identity(s)
                if len(s) and c not in seen:  # of equal sets in a slice, one speaks
                    seen.add(c)
                    x, y = signatures(s, bound, *shared.value)
                    sig.append(x)
                    salt.append(y)
                    own.append(np.full(len(x), node(c), np.int64))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sig, salt, own)],
                                                 names=["sig", "salt", "node"])

    w = Window.partitionBy("sig", "salt")
    rows = docs.select("text").mapInArrow(sign, "sig long, salt long, node long")
    rows = (rows.withColumn("least", F.min("node").over(w)).withColumn("most", F.max("node").over(w))
            .withColumn("size", F.count(F.lit(1)).over(w)).where("least <> most OR salt >= 0").drop("most"))
    rows = written(rows, "jaccard-shared")

    # small groups: which of them are near by their histograms; others, and those of frequent shingles: all
    near = rows.where(f"salt < 0 AND size <= {LEAF}").select("sig", "node").distinct()
    about = scan.groupBy("node").agg(F.max("histogram").alias("histogram"), F.max("n").alias("n"))
    near = near.join(about, "node").repartition("sig").sortWithinPartitions("sig", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sig, own, n, h in whole_groups(batches):
            start = np.append(True, sig[1:] != sig[:-1])
            size = np.diff(np.append(np.nonzero(start)[0], len(sig)))
            few = np.repeat(size <= FEW, size)
            u, v = [], []
            for lag in range(1, min(int(size.max()), FEW)):  # all pairs of the small groups, a distance in the order at a time
                i = np.nonzero((sig[lag:] == sig[:-lag]) & few[lag:])[0]
                i = i[np.abs(h[i] - h[i + lag]).sum(axis=1) <= bound.most_different(n[i], n[i + lag])]
                u.append(own[i])
                v.append(own[i + lag])
            first = np.nonzero(start)[0]
            for a, k in zip(first[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
                g = h[a:a + k]
                close = np.stack([np.abs(g - x).sum(axis=1) for x in g]) <= bound.most_different(n[a:a + k, None], n[None, a:a + k])
                e = np.array(spanning(close), np.int64).reshape(-1, 2) + a
                u.append(own[e[:, 0]])
                v.append(own[e[:, 1]])
            if u:
                pairs = np.unique(np.stack([np.concatenate(u), np.concatenate(v)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    edges = near.mapInArrow(compare, "u long, v long")
    large = rows.where(f"salt >= 0 OR size > {LEAF}").select("sig", "node", "least")
    anchors = large.groupBy("sig").agg(F.min("least").alias("v"))
    tops = large.select("sig", F.col("least").alias("u")).distinct().join(anchors, "sig").select("u", "v")
    stars = large.select(F.col("node").alias("u"), F.col("least").alias("v")).distinct()
    return components(edges.unionByName(stars).unionByName(tops), "jaccard-near")


def _sets(docs: DataFrame, scan: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """``component, cls, n, hashes``: the shingle set of one document of each set that has neighbours."""
    want = scan.join(_few(near), "node").groupBy("component", "cls").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("d"))
    want = written(want.select("component", F.col("cls").alias("own"), F.col("d.id").alias("wid"), F.col("d.th").alias("wth")),
                   "jaccard-want")
    rows = docs.join(_few(want), docs["id"].eqNullSafe(F.col("wid")) & (docs["th"] == F.col("wth")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [shingles(t, k) for t in column(b, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column(b, "component"), column(b, "own"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["component", "cls", "n", "hashes"])

    found = rows.select("component", "own", "text").mapInArrow(run, "component long, cls binary, n long, hashes binary")
    return written(found.dropDuplicates(["cls"]), "jaccard-sets")


def _arrays(g: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(x, U64) for x in g["hashes"]]


def _leaf(bound: Bound, keys: tuple[str, ...]):
    """Exact links of each group, as spanning edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in runs(batches, keys):
            n, cls = g["n"].to_numpy(), g["cls"].tolist()
            if len(g) > 1:
                e = spanning(bound.linked(intersections(_arrays(g)), n[:, None], n[None, :]))
                if e:
                    yield _edges([(cls[i], cls[j]) for i, j in e])
    return run


def _crowds(sets: DataFrame, sizes: DataFrame, bound: Bound) -> DataFrame:
    """Exact links of the neighbourhoods too large for one task.

    Sampled members are pivots. Each document goes to the Voronoi region of its nearest pivot and there to
    a ring by its distance, and rings are dealt into tiles of about ``TILE`` documents. By the triangle
    inequality two tiles can hold a link only if their distances to every pivot come within the radius
    of each other; and tiles that lie wholly within the radius of one pivot are linked through it already.
    The other pairs of tiles, which are the boundary documents' copies, are joined exactly."""
    eps = bound.radius + 1e-9
    crowd = sets.join(sizes, "component")
    rank = F.xxhash64("cls", F.lit(1))
    parts = F.ceil(F.col("size") / TILE).cast("long")
    crowd = crowd.withColumn("part", F.pmod(rank, parts)).withColumn("pivot", F.lit(1))
    pivots = crowd.where(F.pmod(F.xxhash64("cls", F.lit(2)), F.col("size")) < PIVOTS).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).withColumn("pivot", F.lit(0))
    dealt = (crowd.unionByName(pivots).drop("size").repartition("component", "part")
             .sortWithinPartitions("component", "part", "pivot", "cls"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in runs(batches, ("component", "part")):
            p, m = g[g["pivot"] == 0].iloc[:MOST_PIVOTS], g[g["pivot"] == 1]
            if not len(m):
                continue
            n = m["n"].to_numpy()
            flat = np.concatenate(_arrays(m))
            owner = np.repeat(np.arange(len(m)), n)
            far = np.zeros((len(m), max(1, len(p))))
            near = np.zeros((len(m), len(p)), dtype=bool)
            for j, s in enumerate(_arrays(p)):
                hit = s[np.minimum(np.searchsorted(s, flat), len(s) - 1)] == flat
                inter = np.bincount(owner[hit], minlength=len(m))
                far[:, j] = 1 - inter / (n + len(s) - inter)
                near[:, j] = bound.linked(inter, n, len(s))
            region = far.argmin(axis=1)
            own = p["cls"].tolist()
            balls = [[own[j] for j in np.nonzero(x)[0]] for x in near]
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "component": m["component"], "cls": m["cls"], "n": n, "hashes": m["hashes"], "region": region.astype(np.int32),
                "ring": np.floor(far.min(axis=1) / eps).astype(np.int32), "far": [d.tolist() for d in far],
                "balls": balls}), schema=_PLACED, preserve_index=False)

    placed = written(dealt.mapInArrow(place, "component long, cls binary, n long, hashes binary, region int, ring int, "
                                             "far array<double>, balls array<binary>"), "jaccard-placed")
    ring = ["component", "region", "ring"]
    full = placed.groupBy(*ring).agg(F.count(F.lit(1)).alias("full"))
    tiled = placed.join(_few(written(full, "jaccard-rings")), ring).withColumn(
        "tile", F.xxhash64(*ring, F.pmod(F.xxhash64("cls", F.lit(3)), F.ceil(F.col("full") / TILE).cast("long"))))
    tiled = written(tiled.select("component", "tile", "cls", "n", "hashes", "far", "balls"), "jaccard-tiles")
    at = lambda j: F.get("far", F.lit(j))
    meta = tiled.groupBy("component", "tile").agg(F.array(*[F.min(at(j)) for j in range(MOST_PIVOTS)]).alias("lo"),
                                                  F.array(*[F.max(at(j)) for j in range(MOST_PIVOTS)]).alias("hi"))
    meta = written(meta, "jaccard-meta")
    a, b = (meta.select("component", F.col("tile").alias(f"{x}"), F.col("lo").alias(f"lo_{x}"), F.col("hi").alias(f"hi_{x}"))
            for x in "ab")
    zipped = F.arrays_zip("lo_a", "hi_a", "lo_b", "hi_b")
    apart = F.exists(zipped, lambda z: (z["lo_a"] - z["hi_b"] > eps) | (z["lo_b"] - z["hi_a"] > eps))
    inside = F.exists(zipped, lambda z: (z["hi_a"] <= eps - 2e-9) & (z["hi_b"] <= eps - 2e-9))
    pairs = a.join(b, "component").where((F.col("a") <= F.col("b")) & ~F.coalesce(apart, F.lit(False))
                                         & ~F.coalesce(inside, F.lit(False)))
    pairs = written(pairs.select(F.xxhash64("component", "a", "b").alias("pair"), "a", "b"), "jaccard-tilepairs")
    member = tiled.select("tile", "cls", "n", "hashes")
    sides = pairs.select("pair", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    joined = (member.join(sides, "tile").select("pair", "cls", "n", "hashes")
              .repartition("pair").sortWithinPartitions("pair", "cls"))
    inner = joined.mapInArrow(_leaf(bound, ("pair",)), "u binary, v binary")
    return tiled.select(F.col("cls").alias("u"), F.explode("balls").alias("v")).unionByName(inner)


_PLACED = pa.schema([("component", pa.int64()), ("cls", pa.binary()), ("n", pa.int64()), ("hashes", pa.binary()),
                     ("region", pa.int32()), ("ring", pa.int32()), ("far", pa.list_(pa.float64())),
                     ("balls", pa.list_(pa.binary()))])


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """``id, th, n, component_id`` per row."""
    bound = Bound(num, den)
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    scan, *frequent = _scan(d, k)
    near = written(_neighbours(d, scan, frequent, k, bound), "jaccard-component")
    sets = _sets(d, scan, near, k)
    sizes = written(sets.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "jaccard-sizes")
    small = sets.join(_few(sizes.where(f"size <= {LEAF}")), "component").select("component", "cls", "n", "hashes")
    leaves = small.repartition("component").sortWithinPartitions("component", "cls").mapInArrow(
        _leaf(bound, ("component",)), "u binary, v binary")
    links = [leaves]
    large = sizes.where(f"size > {LEAF}")
    if not large.isEmpty():
        links.append(_crowds(sets, _few(large), bound))
    groups = components(written(reduce(DataFrame.unionByName, links), "jaccard-links"), "jaccard-group")

    full = scan.where("n > 0")
    one = full.groupBy("cls").agg(F.min("id").alias("id"))
    one = one.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "id", F.coalesce("component", "cls").alias("component"))
    one = written(one, "jaccard-one")
    least = one.groupBy("component").agg(F.min("id").alias("component_id"))
    one = one.join(least, "component").select("cls", "component_id")
    return full.join(one, "cls").select("id", "th", "n", "component_id").unionByName(
        scan.where("n = 0").select("id", "th", "n", F.col("id").alias("component_id")))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``, the smallest id that links reach.

    A document's set holds its distinct ``k``-word shingles (words: A-Z lower-cased, cut at ASCII white
    space; with fewer words, the whole sequence is one shingle). Two documents link if
    ``den`` * intersection >= ``num`` * union, so equal sets always do. A document without words, or with a
    null text, has an empty set and links with nothing. Every row is a document of its own, also where
    ids repeat; null ids are reached last (a group of them alone gives null). Other columns are not read.
    Sets are of 64-bit hashes, equal sets are known by 128 bits.

    1. Equal sets become one. 2. Hashing cuts each set into so many parts that linked sets must agree in
    one; sets that share such a part and whose 64-range histograms are close enough are neighbours, and
    only they can link. Parts of frequent shingles alone are replaced by a prefix of the rarest shingles;
    which shingles count as frequent only moves costs. 3. The components of this neighbourhood graph are compared
    exactly, in one task up to ``LEAF`` sets; larger ones are split by pivots (``_crowds``).
    Everything between the passes goes through the shared folder. No step sees a bounded part only.
    """
    return _grouped(docs, id_col, text_col, k, num, den).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The document with the smallest id of each group, with all its columns; documents without words all
    stay. Of rows that repeat the id and the text one stays."""
    g = _grouped(docs, id_col, text_col, kw.get("k", 5), kw.get("num", 80), kw.get("den", 100))
    keep = written(g.where("n = 0 OR id <=> component_id").groupBy(F.col("id").alias("kept_id"), F.col("th").alias("kept_th"))
                   .agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("words")), "jaccard-keep")
    # the input row as one struct, whatever its columns are called
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("i"),
                    F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("h"))
    match = d["i"].eqNullSafe(F.col("kept_id")) & (d["h"] == F.col("kept_th"))
    plain = lambda x: x.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    once = plain(d.join(_few(keep.where("times = 1 OR words = 0").select("kept_id", "kept_th")), match, "left_semi"))
    again = keep.where("times > 1 AND words > 0").select("kept_id", "kept_th")
    if again.isEmpty():
        return once
    return once.unionByName(plain(d.join(_few(again), match, "left_semi").dropDuplicates(["i", "h"])))
