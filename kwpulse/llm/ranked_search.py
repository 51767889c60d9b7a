"""Ranked lexical search for many queries at once, by common subexpressions among them."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kwpulse.llm.common import column, slices, written
from kwpulse.llm.decontam import words

BLOCK_PAIRS = 200_000  # (item, term) pairs whose terms travel to the tasks at a time
ACTIVE = 64  # symbols of an item whose pairs are mined; the others are added one by one
CELLS = 1 << 22  # accumulators held at a time: nodes and items x documents


class _Places(dict):
    """Number of a term; -1 for any other."""

    def __missing__(self, term: bytes) -> int:
        return -1


class SharingDag:
    """How the items of a block share partial sums.

    Terms that stand in the same items are one set, a leaf. Then the pair of symbols (leaves or earlier pairs) that
    most items hold becomes a node of its own in all of them, again and again, while at least two items
    hold a pair. An item is the sum of its remaining symbols and of the terms that only it has. Every term of an
    item is in exactly one of these, so sums over the graph are its scores, whatever was mined."""

    def __init__(self, items: list[list[int]], n_terms: int):
        users: list[list[int]] = [[] for _ in range(n_terms)]
        for i, own in enumerate(items):
            for t in own:
                users[t].append(i)
        self.single = np.full(n_terms, -1, np.int64)  # the only item of a term
        self.leaf = np.full(n_terms, -1, np.int64)  # the leaf of a shared term
        leaves: dict[tuple[int, ...], int] = {}
        for t, who in enumerate(users):
            if len(who) == 1:
                self.single[t] = who[0]
            elif who:
                self.leaf[t] = leaves.setdefault(tuple(who), len(leaves))
        self.joins: list[tuple[int, int, int]] = []  # node = one + other, in an order that can be evaluated
        sets: list[set[int]] = [set() for _ in items]
        for who, s in leaves.items():
            for i in who:
                sets[i].add(s)
        held = [len(who) for who in leaves]
        self.nodes = len(leaves)
        mined = [set(sorted(s, key=lambda x: (-held[x], x))[:ACTIVE]) for s in sets]
        rest = [s - a for s, a in zip(sets, mined, strict=True)]
        self._mine(mined)
        self.roots = [sorted(s | a) for s, a in zip(rest, mined, strict=True)]

    def _mine(self, sets: list[set[int]]) -> None:
        pairs: dict[tuple[int, int], set[int]] = {}
        for i, s in enumerate(sets):
            for p in combinations(sorted(s), 2):
                pairs.setdefault(p, set()).add(i)
        heap = [(-len(who), p) for p, who in pairs.items() if len(who) > 1]
        heapq.heapify(heap)
        while heap:
            count, p = heapq.heappop(heap)
            who = pairs.get(p, ())
            if len(who) != -count:
                if len(who) > 1:
                    heapq.heappush(heap, (-len(who), p))
                continue
            del pairs[p]
            new, self.nodes = self.nodes, self.nodes + 1
            self.joins.append((new, *p))
            fresh = set()
            for i in who:
                s = sets[i]
                s.difference_update(p)
                for x in s:
                    for y in p:
                        pairs[(x, y) if x < y else (y, x)].discard(i)
                    pairs.setdefault((x, new), set()).add(i)
                    fresh.add((x, new))
                s.add(new)
            for q in fresh:
                if len(pairs[q]) > 1:
                    heapq.heappush(heap, (-len(pairs[q]), q))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int, n_items: int) -> np.ndarray:
        """Items x documents, from the documents' values by term: each node is summed once for all items over it."""
        acc = np.zeros((self.nodes, n_docs), np.int64)
        leaf = self.leaf[term]
        some = leaf >= 0
        np.add.at(acc.reshape(-1), leaf[some] * n_docs + doc[some], value[some])
        for node, a, b in self.joins:
            np.add(acc[a], acc[b], out=acc[node])
        out = np.zeros((n_items, n_docs), np.int64)
        for i, r in enumerate(self.roots):
            for x in r:
                out[i] += acc[x]
        single = self.single[term]
        some = single >= 0
        np.add.at(out.reshape(-1), single[some] * n_docs + doc[some], value[some])
        return out


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, term``, each pair once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            own = [list(set(words(t))) for t in column(b, "text").to_pylist()]
            at = np.repeat(np.arange(len(own)), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([column(b, "item").take(pa.array(at)), pa.array([t for x in own for t in x], pa.binary())],
                                             names=["item", "term"])

    src = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    return src.mapInArrow(run, f"item {dict(src.dtypes)['item']}, term binary").distinct()


def _blocks(pairs: DataFrame, size: int) -> Iterator[tuple[list, list[list[int]], list[bytes]]]:
    """(items, their terms as numbers, the terms), some ``size`` pairs at a time: items are dealt to hash groups, more of
    them until no group of several items holds more than twice that."""
    sizes = written(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "search-items")
    groups = int((sizes.agg(F.sum("n")).first()[0] or 0) // size) + 1
    group = lambda: F.pmod(F.xxhash64("item"), F.lit(groups))
    while sizes.groupBy(group().alias("g")).agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")).where(
            F.expr(f"c > 1 AND s > {2 * size}")).limit(1).count():
        groups *= 2
    for g in sorted(r[0] for r in sizes.select(group()).distinct().collect()):
        rows = pairs.where(group() == g).orderBy("item", "term").toArrow()
        if rows.num_rows:
            terms = rows["term"].combine_chunks().dictionary_encode()
            item = rows["item"].combine_chunks().dictionary_encode()
            numbers = np.asarray(terms.indices)
            cut = np.nonzero(np.diff(np.asarray(item.indices)))[0] + 1
            yield item.dictionary.to_pylist(), [x.tolist() for x in np.split(numbers, cut)], terms.dictionary.to_pylist()


def _postings(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs``: a row for each document, with its number of terms and those that the items have."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _Places((t, i) for i, t in enumerate(shared.value))
        for b in slices(batches, "text"):
            n, own, tfs = [], [], []
            for t in column(b, "text").to_pylist():
                w = words(t)
                at = np.fromiter(map(place.__getitem__, w), np.int32, len(w))
                k, c = np.unique(at[at >= 0], return_counts=True)
                n.append(len(w))
                own.append(k.astype("<i4").tobytes())
                tfs.append(c.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.array(tfs, pa.binary())],
                                             names=["id", "n", "terms", "tfs"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(src.mapInArrow(run, "id long, n long, terms binary, tfs binary"), "search-postings")


def _frequencies(postings: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(column(b, "terms").to_pylist()), "<i4"), minlength=n_terms)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    rows = postings.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return out


class _Best:
    """The k best documents of each item so far: falling score, then id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = [np.zeros((3, 0), np.int64) for _ in range(n_items)]  # minus score, id is null, id

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        for i in np.nonzero(scores.max(axis=1) >= self.least)[0].tolist():
            at = np.nonzero(scores[i] >= self.least[i])[0]
            rows = np.concatenate([self.rows[i], np.stack([-scores[i][at], none[at], ids[at]])], axis=1)
            if rows.shape[1] >= self.k:
                rows = rows[:, np.lexsort(rows[::-1])[:self.k]]
                self.least[i] = -rows[0, -1]
            self.rows[i] = rows


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The ``k`` best documents of each item: ``item_col``, ``rank`` (from 1), ``id_col`` (long), ``score`` (above 0).

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. With N documents that
    hold a term, L terms in all, n in a document, df and tf as usual, a term weighs w = floor(1000 ln((2N + 2) / (2df + 1))),
    and a document's score is the sum of w * (10^9 tf div (1000 tf + 20 m)), m = 50 + (50 n N div L), over the item's terms, once each.

    The rows of one item id are one item; items without id, text or terms give no rows. A null text has no terms. Every document row
    is a document of its own, repeated ids too; equal scores go by id, null ids last. Other columns are not read. No documents or no
    items: no rows.

    The items go block by block (a bounded number of (item, term) pairs, or one item) and their terms with the tasks. One
    pass over the documents keeps the block's postings in the shared folder; statistics are summed from these. A second
    pass, over the postings, evaluates the ``SharingDag``: shared partial sums once a document, and items from them. Each task keeps
    its k best by item; only these are shuffled.
    """
    pairs = written(_item_terms(items, item_col, item_text_col), "search-pairs")
    kind = dict(pairs.dtypes)["item"]
    sc = docs.sparkSession.sparkContext
    found = []
    for names, own, terms in _blocks(pairs, block_pairs):
        postings = _postings(docs, terms, id_col, text_col)
        n_docs, total = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            break
        df = _frequencies(postings, len(terms))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found.append(postings.where("length(terms) > 0").mapInArrow(
            _ranker(sc.broadcast((names, SharingDag(own, len(terms)), weight)), n_docs, total, k, kind), f"item {kind}, score long, id long"))
    if not found:
        return docs.sparkSession.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _ranker(shared, n_docs: int, total: int, k: int, kind: str):
    item_type = to_arrow_schema(StructType.fromDDL(f"item {kind}")).types[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, dag, weight = shared.value
        best = _Best(len(names), k)
        for b in slices(batches, "terms", max_rows=max(16, min(4096, CELLS // (dag.nodes + len(names))))):
            raw = column(b, "terms").to_pylist()
            term = np.frombuffer(b"".join(raw), "<i4").astype(np.int64)
            tf = np.frombuffer(b"".join(column(b, "tfs").to_pylist()), "<i8")
            doc = np.repeat(np.arange(len(raw)), [len(x) // 4 for x in raw])
            m = np.array([50 + 50 * n * n_docs // total for n in column(b, "n").to_pylist()], np.int64)
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            ids = column(b, "id")
            best.add(dag.scores(doc, term, value, len(raw), len(names)), np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()).astype(np.int64))
        rows = [(names[i], -s, None if none else d) for i, x in enumerate(best.rows) for s, none, d in x.T.tolist()]
        if rows:
            item, score, ids = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, item_type), pa.array(score, pa.int64()), pa.array(ids, pa.int64())],
                                             names=["item", "score", "id"])

    return run
