"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.llm.common import column, slices

TRAIN_PER_CLASS = 3000  # documents of each label that the classifier is fitted on, at most
TRAIN_CHARS = 12_000_000  # characters of text of each label it is fitted on, at most
VOCABULARY = 4000
PREFIXES = (4, 5, 6, 7, 8)  # letters of the word beginnings that count as features
MIN_DOCS = 3  # a word counts as a feature if so many fitted documents hold it
ROUNDS = 300
THRESHOLD = 0.7

_sentence = re.compile(r"[^.!?\n]+")
_word = re.compile(r"[^\W\d_]+")


def held_out(id_col):
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def word_features(word: str) -> list[str]:
    """A word and its beginnings, which inflected and compounded words share."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def sentence_features(text: str, known: dict[str, tuple[int, ...]]) -> Iterator[tuple[int, int, set[int]]]:
    """(start, end, features) of the sentences that hold a feature."""
    for m in _sentence.finditer(text):
        found: set[int] = set()
        for w in _word.findall(m.group().lower()):
            found.update(known[w])
        if found:
            yield m.start(), m.end(), found


class Features(dict):
    """Word -> its features' numbers; remembers the words seen, up to a bound."""

    LIMIT = 1_000_000

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        f = tuple(x for w in word_features(word) if (x := self.vocabulary.get(w)) is not None)
        if len(self) < self.LIMIT:
            self[word] = f
        return f

    def __reduce__(self):
        return Features, (self.vocabulary,)


@dataclass
class Model:
    """Sentence scores are logistic in the words of a vocabulary: ``bias`` and ``weights``. A document's
    score is the noisy-or of its sentences, and ``prior`` if no sentence holds a feature word."""

    known: Features
    weights: np.ndarray
    bias: float
    prior: float

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that hold a feature word, in order."""
        return [(s, e, 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(float(self.weights[x]) for x in sorted(f)))))))
                for s, e, f in sentence_features(text, self.known)]

    def score(self, text: str) -> float:
        clean = 0.0
        for _, _, p in self.sentences(text):
            clean += math.log1p(-p)
        return min(1.0, max(self.prior, -math.expm1(clean)))


def fit(texts: list[str], labels: list[int]) -> Model:
    """Fit sentence weights to document labels through the noisy-or: the chance of a clean document is
    the product of its sentences' chances. Adam on the mean negative log-likelihood with a squared
    penalty. Features are the words and word beginnings whose presence differs most between the labels (log odds times
    its weight of evidence), so that rare ones don't drown them."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(Features({}), np.zeros(0), -30.0, float(y.mean()) if len(y) else 0.0)
    n1, n0 = y.sum(), len(y) - y.sum()
    with_label: tuple[Counter, Counter] = (Counter(), Counter())
    for t, v in zip(texts, labels, strict=True):
        with_label[v].update({f for w in set(_word.findall(t.lower())) for f in word_features(w)})

    def evidence(w):
        a, c = with_label[1][w], with_label[0][w]
        p, q = (a + 0.5) / (n1 + 1), (c + 0.5) / (n0 + 1)
        pooled = (a + c + 1) / (len(y) + 2)
        return abs(p - q) / math.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    words = [w for w in with_label[0].keys() | with_label[1].keys() if with_label[0][w] + with_label[1][w] >= MIN_DOCS]
    words = sorted(words, key=lambda w: (-evidence(w), w))[:VOCABULARY]
    known = Features({w: i for i, w in enumerate(words) if evidence(w) >= 3.0})

    doc, sent, feat, s = [], [], [], 0
    for d, t in enumerate(texts):
        for _, _, f in sentence_features(t, known):
            doc.append(d)
            sent.extend([s] * len(f))
            feat.extend(sorted(f))
            s += 1
    doc, sent, feat = np.array(doc, int), np.array(sent, int), np.array(feat, int)
    w, b = np.zeros(len(known.vocabulary)), -3.0
    balance = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0)) / len(y)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, ROUNDS + 1):
        z = np.clip(b + np.bincount(sent, w[feat], s), -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.bincount(doc, np.logaddexp(0, z), len(y))  # -log of the chance that all are clean
        pull = -1 / np.expm1(np.maximum(clean, 1e-6))  # of a toxic document on each sentence
        g = p * (balance * np.where(y == 1, pull, 1.0))[doc]
        grad = np.append(np.bincount(feat, g[sent], len(w)) + 1e-4 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(known, w, float(b), 0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit on labelled rows that are not held out: per label at most ``TRAIN_PER_CLASS`` documents, by
    the order of a hash of the id, and ``TRAIN_CHARS`` characters of whole texts (the first document is
    taken in any case). Rows without a text or with a label other than 0 or 1 are not used; where an id
    is labelled more than once, its highest label counts. Without labels of both kinds the score is
    the share of label 1 (0 without labels)."""
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .where("_id IS NOT NULL AND _y IN (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
             .where(~held_out(F.col("_id"))))
    # which rows: ids and lengths of a bounded number of labelled documents, least hashes first
    rank = F.xxhash64(F.col("_id"), F.lit(8))
    size = docs.select(F.col(id_col).alias("_id"), F.length(text_col).alias("_n")).where("_n IS NOT NULL")
    chosen = []
    for y in (0, 1):
        rows = (known.where(F.col("_y") == y).join(size, "_id").groupBy("_id").agg(F.max("_n").alias("_n"))
                .select("_id", "_n", rank.alias("_r")).orderBy("_r", "_id").limit(TRAIN_PER_CLASS).collect())
        total = 0
        for k, r in enumerate(rows):
            total += r["_n"]
            if k and total > TRAIN_CHARS:
                break
            chosen.append((r["_id"], y))
    if not chosen:
        return fit([], [])
    ids = spark.createDataFrame(chosen, f"_id {dict(docs.dtypes)[id_col]}, _y int")
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).where("_t IS NOT NULL")
            .join(F.broadcast(ids), "_id").groupBy("_id").agg(F.first("_y").alias("_y"), F.min("_t").alias("_t"))
            .orderBy("_id").toArrow().to_pylist())
    return fit([r["_t"] for r in rows], [r["_y"] for r in rows])


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, with_sentences: bool = False) -> DataFrame:
    """One row per input row: id, ``score`` (0 to 1, higher: more likely toxic), ``predicted`` (1 from
    ``threshold`` on) and, with ``with_sentences``, ``sentences``: start, end (code points, end
    exclusive) and score of the sentences that reach the threshold themselves, or of the highest one
    if the document does only by several. Whole texts are read, in slices of about 8 MB; a null or
    empty text gets the score of a text without known words. Other columns are not read; repeated
    rows are scored each. No shuffle; the model (at most ``VOCABULARY`` words) travels with the task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    src = docs.select(id_col, text_col)
    schema = f"`{id_col}` {dict(src.dtypes)[id_col]}, score double, predicted int"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    if with_sentences:
        schema += ", sentences array<struct<start: long, end: long, score: double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text_col):
            texts = [t or "" for t in column(b, text_col).to_pylist()]
            scores = [m.score(t) for t in texts]
            cols = [column(b, id_col), pa.array(scores, pa.float64()),
                    pa.array([int(x >= threshold) for x in scores], pa.int32())]
            names = [id_col, "score", "predicted"]
            if with_sentences:
                spans = []
                for t, x in zip(texts, scores, strict=True):
                    all_ = m.sentences(t) if x >= threshold else []
                    hit = [s for s in all_ if s[2] >= threshold] or sorted(all_, key=lambda s: (-s[2], s[0]))[:1]
                    spans.append([{"start": s, "end": e, "score": p} for s, e, p in hit])
                cols.append(pa.array(spans, kind))
                names.append("sentences")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text stays under the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text_col):
            yield b.filter(pa.array([m.score(t or "") < threshold for t in column(b, text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
