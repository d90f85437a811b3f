"""Encoding text with the vocabulary of a public byte-level BPE tokenizer.

Two tiers: a minimal perfect hash resolves every pre-token that is itself in the vocabulary; the rest go through a
heap of candidate merges over a linked list of bytes.  Before the second tier a pre-token is cut wherever no
vocabulary entry can span the two characters, which changes no result (a merge there is impossible) and makes the
pieces short enough to recur.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Folder of the vocabulary files, and the tokenizer's pre-token pattern.
FOLDER = "/opt/tokenizers"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries that each worker remembers between batches; only speed depends on it.
MEMO = 300_000


class PerfectHash:
    """Minimal perfect hash over fixed byte strings by hash and displace: n slots for n keys.

    A first hash picks a bucket, the bucket's seed picks the slot.  Seeds are found once at build time, largest
    bucket first.  A slot keeps a 64-bit fingerprint; a hit is confirmed on the key's bytes.
    """

    def __init__(self, keys: list[bytes], load: int = 4) -> None:
        n = self.n = len(keys)
        self.buckets = max(1, n // load)
        h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64, count=n)
        self.seeds = np.zeros(self.buckets, dtype=np.uint64)
        self.slot_of = np.full(n, -1, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        tries = np.arange(64, dtype=np.uint64)[:, None]
        for b in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            own = order[starts[b] : starts[b + 1]]
            seed = np.uint64(0)
            while True:
                s = self._slot(h[own], seed + tries)
                free = ~taken[s].any(axis=1)
                if free.any():
                    ranked = np.sort(s[free], axis=1)
                    apart = (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                    if apart.any():
                        k = np.flatnonzero(free)[np.flatnonzero(apart)[0]]
                        break
                seed += np.uint64(64)
            self.seeds[b] = seed + np.uint64(k)
            taken[s[k]] = True
            self.slot_of[s[k]] = own
        # a bucket of one key takes any free slot, which its seed then names outright
        alone, free = np.flatnonzero(sizes == 1), np.flatnonzero(~taken)
        self.direct = np.full(self.buckets, -1, dtype=np.int64)
        self.direct[alone] = free[: len(alone)]
        self.slot_of[free[: len(alone)]] = order[starts[alone]]
        self.keys = [keys[i] for i in self.slot_of]

    def _slot(self, h: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (h ^ (seed * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x94D049BB133111EB)
            return ((x >> np.uint64(20)) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """The key's index for each word, -1 for a word that is no key."""
        if not words or not self.n:
            return np.full(len(words), -1, dtype=np.int64)
        h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        slot = np.where(self.direct[bucket] >= 0, self.direct[bucket], self._slot(h, self.seeds[bucket]))
        keys = self.keys
        same = np.fromiter((keys[s] == w for s, w in zip(slot.tolist(), words)), dtype=bool, count=len(words))
        return np.where(same, self.slot_of[slot], -1)


def char_span(token: bytes, i: int) -> tuple[bytes, bytes]:
    """The bytes of the characters before and after position i, as far as the token holds them."""
    a = i - 1
    while a > 0 and i - a < 4 and 0x80 <= token[a] < 0xC0:
        a -= 1
    b = i + 1
    while b < len(token) and b - i < 4 and 0x80 <= token[b] < 0xC0:
        b += 1
    return token[a:i], token[i:b]


class ByteBpe:
    """Encoder of one vocabulary file; without special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        keys = sorted(self.rank)
        self.table = PerfectHash(keys)
        self.key_id = np.array([self.rank[k] for k in keys], dtype=np.int32)
        self.bridges = {char_span(t, i) for t in keys for i in range(1, len(t)) if not 0x80 <= t[i] < 0xC0}
        self.pattern = regex.compile(PATTERN)
        self.joined: dict[str, bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.words: dict[str, list[int]] = {}

    def bridged(self, two: str) -> bool:
        """Whether a vocabulary entry may hold bytes of both characters."""
        a, b = two[0].encode(), two[1].encode()
        return any((a[i:], b[:j]) in self.bridges for i in range(len(a)) for j in range(1, len(b) + 1))

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece: lowest rank first, leftmost on ties."""
        rank, n = self.rank, len(data)
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(data[i : i + 2])
            if r is not None:
                heap.append((r, i, data[i : i + 2]))
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = both + part[k]
                if (r := rank.get(wider)) is not None:
                    heapq.heappush(heap, (r, i, wider))
            if (k := before[i]) >= 0:
                wider = part[k] + both
                if (r := rank.get(wider)) is not None:
                    heapq.heappush(heap, (r, k, wider))
        return [rank[p] for p in part if p is not None]

    def miss(self, word: str) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        if word.isascii():
            return self.merge(word.encode())
        joined, pieces, out, start = self.joined, self.pieces, [], 0
        for i in range(1, len(word) + 1):
            if i < len(word):
                two = word[i - 1 : i + 1]
                if (j := joined.get(two)) is None:
                    j = joined[two] = self.bridged(two)
                if j:
                    continue
            piece = word[start:i]
            start = i
            if (ids := pieces.get(piece)) is None:
                ids = pieces[piece] = self.merge(piece.encode())
            out += ids
        return out

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of a batch; empty and null texts give no ids."""
        number: dict[str, int] = {}
        find, word_no, ends = self.pattern.findall, [], []
        for t in texts:
            if t:
                word_no += [number.setdefault(w, len(number)) for w in find(t)]
            ends.append(len(word_no))
        for memo in (self.words, self.pieces, self.joined):
            if len(memo) > MEMO:
                memo.clear()
        memo = self.words
        new = [w for w in number if w not in memo]
        found = self.table.lookup([w.encode() for w in new])
        ids = self.key_id[found].tolist() if new else []
        for w, hit, i in zip(new, found.tolist(), ids):
            memo[w] = [i] if hit >= 0 else self.miss(w)
        lists = [memo[w] for w in number]
        size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(size.sum()))
        first = np.concatenate([[0], np.cumsum(size)])[:-1] if len(lists) else np.zeros(0, dtype=np.int64)
        no = np.array(word_no, dtype=np.int64)
        per = size[no] if len(no) else np.zeros(0, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(per)])
        take = np.repeat(first[no] - upto[:-1], per) + np.arange(int(upto[-1])) if len(no) else np.zeros(0, dtype=np.int64)
        offsets = np.concatenate([[0], upto[np.array(ends, dtype=np.int64)]]) if ends else np.zeros(1, dtype=np.int64)
        return offsets, flat[take]


_loaded: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """The encoder of a file, built once in each process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def vocabulary(name: str = "byte_bpe_50k", folder: str = FOLDER) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


#: Rows encoded at once within an Arrow batch, to bound memory on long texts.
ROWS = 1000


def slices(column: pa.Array) -> Iterator[list[str | None]]:
    for i in range(0, len(column), ROWS):
        yield column.slice(i, ROWS).to_pylist()


def encode(text: Column | str, path: str | None = None) -> Column:
    """Token ids of a text as array<int>; empty and null texts give an empty list."""
    at = path or vocabulary()

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids(column: pa.Array) -> pa.Array:
        bpe, parts = encoder(at), []
        for texts in slices(column):
            offsets, flat = bpe.encode_batch(texts)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return ids(F.col(text) if isinstance(text, str) else text)


def count(text: Column | str, path: str | None = None) -> Column:
    """Number of tokens of a text; 0 for empty and null texts."""
    at = path or vocabulary()

    @F.arrow_udf(IntegerType())
    def tokens(column: pa.Array) -> pa.Array:
        bpe = encoder(at)
        parts = [np.diff(bpe.encode_batch(texts)[0]) for texts in slices(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), pa.int32())

    return tokens(F.col(text) if isinstance(text, str) else text)


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: its id and `ids`.  Nulls: a null id stays null; repeated rows each give a row."""
    return docs.select(F.col(id_col), encode(F.col(text_col), path).alias("ids"))
