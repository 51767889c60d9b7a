"""Token counts by prefix dynamic programming: the exact count at every prefix of a text."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwpulse.llm.bpe import byte_letters
from kwpulse.llm.common import column, slices

LIMIT = 512  # tokens of a budget
SHIFT = 20  # bits of an id in a packed pair
BORDER = "\xff"  # a byte that UTF-8 text never holds stands between pieces
# Fixed value: how byte-level BPE files of this kind cut a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_split = regex.compile(PATTERN, regex.V0)
_other = regex.compile(r"[^\x00-ɏ]|[\x1C-\x1F\x85]")  # scripts and white space that the library cuts itself
_run = regex.compile(r"\s{2,}(?=\S)")
_LATE = {"'re", "'ve", "'ll"}  # a prefix of these is two pieces


class PrefixCounter:
    """Token counts of every prefix under a byte-level BPE file of the ``tokenizers`` library.

    Where merges come in the order of the ids they make, a sequence of tokens is what merging yields exactly if
    each adjacent pair is (``compatible``). So every prefix of a piece has exactly one last token: the one that
    ends there and is compatible with the last token of the prefix before it. One pass of an
    Aho-Corasick automaton over a piece meets all tokens that end at each byte, and the count of a prefix is
    the count of the prefix before its last token, plus one.
    """

    MAX_CACHE = 400_000
    GROUP = 1 << 20  # bytes of new pieces taken together

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab, pre = spec["model"], spec["model"]["vocab"], spec["pre_tokenizer"]
        if (spec["normalizer"] is not None or model["type"] != "BPE" or model["end_of_word_suffix"] or model["byte_fallback"]
                or model["continuing_subword_prefix"] or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]):
            raise ValueError("a byte-level BPE file without normaliser, suffixes and added blank is expected")
        self.library = Tokenizer.from_file(path)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that take neighbouring characters with them are not expected")
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        size = 1 + max(vocab.values())
        self.left, self.right = [-1] * size, [-1] * size
        self.merged: dict[int, int] = {}
        last = -1
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            i = vocab[a + b]
            if i <= last or i <= max(vocab[a], vocab[b]):
                raise ValueError("merges are not in the order of their ids")
            last = i
            self.left[i], self.right[i] = vocab[a], vocab[b]
            self.merged[vocab[a] << SHIFT | vocab[b]] = i
        plain = {c: chr(b) for b, c in enumerate(byte_letters())}
        whole = [False] * size  # tokens that merging rebuilds
        self.tokens = ahocorasick.Automaton()
        for t, i in sorted(vocab.items(), key=lambda x: x[1]):
            a, b = self.left[i], self.right[i]
            if a >= 0:
                whole[i] = whole[a] and whole[b] and self.compatible(a, b, i)
            else:
                whole[i] = len(t) == 1
            own = "".join(plain[c] for c in t) if whole[i] else BORDER
            if BORDER not in own:
                self.tokens.add_word(own, (i, len(own)))
        self.tokens.make_automaton()
        self.known: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def compatible(self, a: int, b: int, limit: int = 1 << 40) -> bool:
        """Whether a + b, merged by ranks below ``limit``, ends as (a, b): the later of the two tokens' last
        merges is undone, again and again; the pair at the border must never merge before that."""
        left, right, merged = self.left, self.right, self.merged
        while True:
            if merged.get(a << SHIFT | b, limit) < limit:
                return False
            if left[a] >= 0 and (left[b] < 0 or a > b):
                limit, a = a, right[a]
            elif left[b] >= 0:
                limit, b = b + 1, left[b]
            else:
                return True

    def _tables(self, pieces: list[str]) -> list[bytes]:
        """For each piece the change of the count at each character, as 16-bit integers."""
        data = BORDER.join(p.encode("utf-8", "surrogatepass").decode("latin-1") for p in pieces) + BORDER
        last, count = array("i", [-1]) * (len(data) + 1), array("i", [0]) * (len(data) + 1)
        known, compatible = self.known, self.compatible
        for end, (t, n) in self.tokens.iter(data):
            start = end + 1 - n
            before = last[start]
            if before >= 0:
                key = before << SHIFT | t
                ok = known.get(key)
                if ok is None:
                    ok = compatible(before, t)
                    if len(known) < 4 * self.MAX_CACHE:
                        known[key] = ok
                if not ok:
                    continue
            elif start and data[start - 1] != BORDER:
                continue
            last[end + 1], count[end + 1] = t, count[start] + 1
        raw = np.frombuffer(data.encode("latin-1"), np.uint8)
        is_end = (raw != 0xFF) & np.append((raw[1:] & 0xC0) != 0x80, True)  # the last byte of a character
        at = np.nonzero(is_end)[0]
        value = np.frombuffer(count, np.int32)[1:][at]
        piece = np.cumsum(raw == 0xFF)[at]
        first = np.append(True, piece[1:] != piece[:-1])
        step = value - np.where(first, 0, np.append(0, value[:-1]))
        if len(step) and np.abs(step).max() > 32767:
            raise OverflowError("the token count of neighbouring prefixes differs too much")
        cut = np.append(np.nonzero(first)[0], len(step))
        step = step.astype("<i2")
        out = [step[i:j].tobytes() for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        return [np.array([1, 1, value[j - 1] - 2], "<i2").tobytes() if p in _LATE else x
                for p, x, j in zip(pieces, out, cut[1:].tolist(), strict=True)]

    def tables(self, pieces: set[str]) -> dict[str, bytes]:
        """``_tables`` of the pieces that the cache does not hold; frequent ones come early and stay in it."""
        out, group, size = {}, [], 0
        for p in pieces:
            group.append(p)
            size += len(p)
            if size >= self.GROUP:
                out.update(zip(group, self._tables(group), strict=True))
                group, size = [], 0
        if group:
            out.update(zip(group, self._tables(group), strict=True))
        return out

    def pieces(self, text: str) -> list[str]:
        if _other.search(text):
            return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return _split.findall(text)

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the change of its token count at each character: the sum of the first p of them is the
        count that the library gives for the first p characters taken as a text."""
        units: list[tuple[str, str | None]] = []  # a stretch without special tokens, and the one after it
        sizes = []
        for t in texts:
            cut = self.special_split.split(t) if self.special_split else [t]
            own = [(s, cut[k + 1] if k + 1 < len(cut) else None) for k, s in enumerate(cut) if k % 2 == 0]
            units += own
            sizes.append(len(own))
        # a prefix may end within the special token: its characters are text then
        plain = [s if e is None else s + e[:-1] for s, e in units]
        cut = [self.pieces(s) for s in plain]
        runs = [list(_run.finditer(s)) for s in plain]
        cache = self.cache
        new = {p for own in cut for p in own if p not in cache}
        new.update(m.group() for own in runs for m in own if m.group() not in cache)
        found = self.tables(new)
        room = self.MAX_CACHE - len(cache)
        for p, x in found.items():
            if room <= 0:
                break
            if len(p) < 32:
                cache[p] = x
                room -= 1
        get = lambda p: cache[p] if p in cache else found[p]
        parts = []
        for (s, special), ps, rs in zip(units, cut, runs, strict=True):
            if len(found):
                own = np.frombuffer(b"".join([get(p) for p in ps]), "<i2")
            else:
                own = np.frombuffer(b"".join(map(cache.__getitem__, ps)), "<i2")
            if rs or special:
                own, total = own.astype(np.int64), np.append(0, np.cumsum(own, dtype=np.int64))
                for m in rs:  # a prefix that ends with white space ends with one piece of it
                    more = total[m.start()] + int(np.frombuffer(get(m.group()), "<i2").sum()) - total[m.end()]
                    own[m.end() - 1] += more
                    own[m.end()] -= more
                if special:
                    total = np.append(0, np.cumsum(own))
                    own = np.append(own, total[len(s)] + 1 - total[-1])
                own = own.astype("<i2")
            parts.append(own)
        out, at = [], 0
        for n in sizes:
            out.append(parts[at] if n == 1 else np.concatenate(parts[at:at + n]))
            at += n
        return out


_loaded: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One copy per worker process."""
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def within(steps: np.ndarray, limit: int) -> int:
    """The length of the longest prefix of at most ``limit`` tokens (a longer prefix may have fewer tokens)."""
    if limit < 0:
        return 0
    ok = np.nonzero(np.cumsum(steps, dtype=np.int64) <= limit)[0]
    return int(ok[-1]) + 1 if len(ok) else 0


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                  with_steps: bool = True) -> DataFrame:
    """The token count of every prefix of each whole text: one row per input row.

    Columns: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``), ``fits`` (characters
    of the longest prefix of at most ``limit`` tokens) and, with ``with_steps``, ``steps``: for each character the change of
    the count as 16-bit little-endian integers, so that their running sum is the exact count at each prefix.
    ``count_at`` and ``truncated`` answer later questions from a stored frame of these, without encoding again.

    A prefix is a text of its own: it counts as ``path``'s library counts it, special strings in it as the tokens
    they stand for, no tokens added. A null text counts as empty: no bytes, no tokens, no steps. Repeated rows are counted
    each, null ids stay, other columns are not read. No shuffle: rows are counted where they are read, in slices of
    about 4 MB of text; one very long text is one slice. ``path`` must exist on every executor.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in column(b, "text").to_pylist()]
            steps = c.steps(texts)
            n = [int(x.sum(dtype=np.int64)) for x in steps]
            cols = [column(b, "id"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                    pa.array([len(x) if k <= limit else within(x, limit) for x, k in zip(steps, n, strict=True)], pa.int64())]
            names = [id_col, "n_bytes", "n_tokens", "over_limit", "fits"]
            if with_steps:
                cols.append(pa.array([x.tobytes() for x in steps], pa.binary()))
                names.append("steps")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fits long"
                          + (", steps binary" if with_steps else ""))


def _answered(stored: DataFrame, answer, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "steps"):
            steps = [np.frombuffer(x or b"", "<i2") for x in column(b, "steps").to_pylist()]
            out = [answer(x, q) for x, q in zip(steps, column(b, "asked").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array(out, pa.int64())], names=["row", name])

    kind = dict(stored.dtypes)["row"]
    return stored.select("row", "steps", "asked").mapInArrow(run, f"row {kind}, {name} long").select("row.*", name)


def count_at(stored: DataFrame, questions: DataFrame, id_col: str = "doc_id", chars_col: str = "chars") -> DataFrame:
    """``questions`` (id, number of characters) with ``n_tokens`` of that prefix, from a stored ``prefix_counts``.

    An equi-join on the id. A length beyond the text's is the whole text, one below 0 the empty text; null lengths and
    unknown or null ids give no row; a repeated id answers for each of its rows."""
    asked = questions.select(F.col(id_col), F.col(chars_col).alias("asked")).where("asked IS NOT NULL")
    both = stored.select(id_col, "steps").join(asked, id_col)
    return _answered(both.select(F.struct(F.col(id_col), F.col("asked").alias(chars_col)).alias("row"), "steps", "asked"),
                     lambda x, q: int(x[:max(0, q)].sum(dtype=np.int64)), "n_tokens")


def truncated(stored: DataFrame, budget: int, id_col: str = "doc_id") -> DataFrame:
    """Id and ``chars``, the length of the longest prefix within ``budget`` tokens, from a stored ``prefix_counts``."""
    return _answered(stored.select(F.struct(F.col(id_col)).alias("row"), "steps", F.lit(budget).alias("asked")), within, "chars")
