"""BPE encoding and decoding: greedy proposals, vectorised pair checks, exact merging of the rest."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kwpulse.llm.common import column, slices

ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"
BITS = 20  # of an id in a packed pair


def byte_letters() -> list[str]:
    """The printable character that byte-level BPE vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A ``tokenizers`` BPE file whose merges are in the order of the ids they make.

    Such a file (checked here) splits every merged token in one way, and a merge of smaller id comes
    first. Then a sequence of tokens is what merging yields exactly if each adjacent pair, encoded
    alone, yields that pair; ``compatible`` tests this by undoing merges, for whole arrays at once.
    """

    MAX_CACHE = 1_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.library = Tokenizer.from_file(path)  # its normaliser and splitter, for rare scripts
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in x)
        self.split = regex.compile(self.pattern, regex.V0)
        self.suffix = model["end_of_word_suffix"] or ""
        if not self.suffix or spec["decoder"] is not None or model["byte_fallback"]:
            raise ValueError("a vocabulary with an end-of-word suffix and without a decoder is expected")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.vocab = vocab
        size = 1 + max(*vocab.values(), *self.special.values())
        self.text = np.empty(size, dtype=object)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = t
        left, right = np.arange(size), np.arange(size)
        keys, made = [], []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            i = vocab[a + b]
            if left[i] != i or (made and i <= made[-1]) or i <= max(vocab[a], vocab[b]):
                raise ValueError("merges are not in the order of their ids")
            left[i], right[i] = vocab[a], vocab[b]
            keys.append(vocab[a] << BITS | vocab[b])
            made.append(i)
        self.left, self.right = left, right
        order = np.argsort(np.array(keys))
        self.keys, self.made = np.array(keys)[order], np.array(made)[order]
        self.ranks = dict(zip(keys, made, strict=True))
        letters = byte_letters()
        self.letters = str.maketrans({b: letters[b] for b in range(256)})
        self.longest = max(len(t.removesuffix(self.suffix)) for t in vocab)
        self.cache: dict[str, tuple[int, ...]] = {}
        # a token that merging would not rebuild can't be proposed
        own = [self.merge(t) == [i] if left[i] != i else True for t, i in vocab.items()]
        self.proposals = {t: i for (t, i), ok in zip(vocab.items(), own, strict=True) if ok}

    def letters_of(self, word: str) -> str:
        """A word's bytes, written as the vocabulary writes them."""
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def symbols(self, letters: str) -> list[int]:
        """Single letters, the last with the suffix; ``letters`` may be a token that ends in it."""
        if letters.endswith(self.suffix):
            body = letters.removesuffix(self.suffix)
            return [*(self.vocab[c] for c in body[:-1]), self.vocab[body[-1] + self.suffix]]
        return [self.vocab[c] for c in letters]

    def merge(self, letters: str) -> list[int]:
        """Exact BPE: the merge of smallest rank, leftmost first, again and again. A heap over a linked
        list, so that long words take n log n steps."""
        ids = self.symbols(letters)
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = lambda i: self.ranks.get(ids[i] << BITS | ids[after[i]]) if after[i] >= 0 else None
        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (x := rank(k)) is not None:
                    heapq.heappush(heap, (x, k))
        return [x for x in ids if x >= 0]

    def propose(self, letters: str) -> list[int]:
        """Greedy longest match from the left; at the end of a word, tokens with the suffix."""
        out, i, n, get = [], 0, len(letters), self.proposals.get
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                t = get(letters[i:j] + self.suffix if j == n else letters[i:j])
                if t is not None:
                    break
            out.append(t)
            i = j
        return out

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id each pair merges to; a value beyond all ids if it doesn't."""
        key = a << BITS | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], 1 << BITS)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a + b, encoded alone, yields (a, b): go back from the last merges inside a and b, and
        see at each step whether the two symbols at the border would have merged before the inner merge
        that took one of them away. At equal ranks the left merge comes first."""
        ok = np.ones(len(a), dtype=bool)
        where = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << BITS)  # the border pair must not merge before this rank
        while len(where):
            bad = self.pair(a, b) < limit
            ok[where[bad]] = False
            base_a, base_b = self.left[a] == a, self.left[b] == b
            open_a = ~base_a & (base_b | (a > b))  # undo the later merge; at a tie, of equal ids, b's
            open_b = ~base_b & ~open_a
            # undoing a's last merge brings back a right part, which lived until that merge, rank a;
            # a border merge of the same rank further right would have come after it
            limit = np.where(open_a, a, np.where(open_b, b + 1, limit))
            a, b = np.where(open_a, self.right[a], a), np.where(open_b, self.left[b], b)
            go = ~bad & (open_a | open_b)
            where, a, b, limit = where[go], a[go], b[go], limit[go]
        return ok

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word, as merging yields them."""
        new = [w for w in words if w not in self.cache]
        found = {}
        if new:
            letters = [self.letters_of(w) for w in new]
            out = [self.propose(x) for x in letters]
            sizes = np.fromiter(map(len, out), np.int64, len(out))
            flat = np.fromiter((t for x in out for t in x), np.int64, int(sizes.sum()))
            ends = np.cumsum(sizes)
            inner = np.ones(len(flat), dtype=bool)
            inner[ends - 1] = False
            at = np.nonzero(inner)[0]
            wrong = at[~self.compatible(flat[at], flat[at + 1])]
            for i in np.unique(np.searchsorted(ends, wrong, side="right")).tolist():
                out[i] = self.merge(letters[i] + self.suffix)
            found = {w: tuple(x) for w, x in zip(new, out, strict=True)}
        result = [found[w] if w in found else self.cache[w] for w in words]
        room = self.MAX_CACHE - len(self.cache)  # frequent words come early and stay
        self.cache.update((w, found[w]) for w in new[:max(0, room)] if len(w) < 64)
        return result

    def words(self, text: str) -> list[str]:
        """The normalised text, split into words. Latin letters go by Python's own functions, which
        agree with the library there; other texts by the library's normaliser and splitter."""
        if _other.search(text):
            text = self.library.normalizer.normalize_str(text)
            return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.split.findall(text.lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; special tokens in a text are taken as such, as the library does."""
        parts: list = []  # per text: its words, with special ids between them
        for t in texts:
            if self.special_split is not None and "<|" in t:
                p: list = []
                for k, s in enumerate(self.special_split.split(t)):
                    p += [self.special[s]] if k % 2 else self.words(s)
                parts.append(p)
            else:
                parts.append(self.words(t))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.empty(int(sizes.sum()), dtype=object)
        flat[:] = [w for p in parts for w in p]
        codes, unique = pd.factorize(flat)
        plain = [w for w in unique if isinstance(w, str)]
        ids = dict(zip(plain, self.encode_words(plain), strict=True))
        ids_of = [ids[w] if isinstance(w, str) else (w,) for w in unique]
        n = np.fromiter(map(len, ids_of), np.int64, len(ids_of))
        table = np.fromiter((t for x in ids_of for t in x), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        per_word = n[codes]
        ends = np.cumsum(per_word)
        all_ids = table[np.repeat(first[codes] - (ends - per_word), per_word) + np.arange(int(per_word.sum()))]
        cuts = np.concatenate([[0], ends])[np.cumsum(sizes)] if len(flat) else np.zeros(len(parts), np.int64)
        return np.split(all_ids, cuts[:-1]) if len(parts) else []

    def decode(self, ids: np.ndarray) -> str:
        """The tokens as they stand in the vocabulary, with blanks between them: what the library
        returns for a file without a decoder."""
        return " ".join(self.text[ids].tolist())


_other = regex.compile(r"[^\x00-\u024F]|[\x1C-\x1F\x85\u0130]")  # other scripts; white space and case that differ
_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One copy per worker process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """Encode each whole text and decode it again: one row per input row.

    Columns: ``id_col``, those in ``keep``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` and, with ``with_ids``, ``ids`` and ``decoded``.
    A null text counts as empty: no ids. ``path`` is a vocabulary file on every executor (the loaded
    copy is kept per worker). No shuffle: every row is encoded where it is read, in slices of about
    8 MB of text, so only the longest single text sets the memory beyond that. Words met before come
    from a bounded cache. Repeated rows are encoded each; other columns are dropped, and so are columns of ``keep``
    with the name of a result.
    """
    kept = list(dict.fromkeys([id_col, *keep]))
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if with_ids else [])
    if id_col in made:
        raise ValueError(f"the id column must not be called {id_col}")
    kept = [c for c in kept if c not in made]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    results = StructType.fromDDL(ENCODED + (", ids array<int>, decoded string" if with_ids else ""))
    schema = StructType([src.schema["row"], *results.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in slices(batches, "text"):
            ids = v.encode([t or "" for t in column(b, "text").to_pylist()])
            texts = [v.decode(x) for x in ids]
            cols = [
                column(b, "row"), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string())]
            if with_ids:
                cols += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", *made])

    return src.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *made)
