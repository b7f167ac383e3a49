"""Byte-level BPE: encode texts to token ids and back, with the ranks of a given vocabulary file.

Two tiers. A pre-token that is itself in the vocabulary is found through a minimal perfect hash: its 64-bit hash picks a bucket,
the bucket's displacement gives the one slot where the token could be, and one comparison settles it. Any other pre-token is
merged from its bytes: a doubly linked list of pieces and a heap of (rank, position) for neighbours that form a token; the lowest
rank merges first, the leftmost among equals, in O(n log n) for a pre-token of n bytes.

Texts are independent, so the work is a map over the table without a shuffle. The pattern's classes are those of the installed
``regex``; letters that only newer Unicode versions than the encoder of another library know may be split otherwise there.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame

from riskloom.llm.texts import Shipped, in_chunks, map_documents, worker_cache

#: Pre-tokens a worker remembers with their ids, in each of two generations.
MEMO = 200_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ids, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: n keys, n slots, one small integer for two keys on average."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = n // 2 + 1
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        if len(set(hashes)) != n:
            raise ValueError("the keys are not distinct")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        self.shift, self.key_at = [0] * self.buckets, [-1] * n
        # Crowded buckets first, while there is room; a bucket of one key gets its slot directly, written as a negative number.
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        free = None
        for b in order:
            own = members[b]
            if len(own) > 1:
                d = 0
                while True:
                    slots = [self._slot(hashes[i], d) for i in own]
                    if len(set(slots)) == len(own) and all(self.key_at[s] < 0 for s in slots):
                        break
                    d += 1
                self.shift[b] = d
            elif own:
                free = free or iter([s for s in range(n) if self.key_at[s] < 0])
                slots = [next(free)]
                self.shift[b] = -1 - slots[0]
            for i, s in zip(own, slots if own else ()):
                self.key_at[s] = i

    def _slot(self, h: int, d: int) -> int:
        # Each displacement is another multiplicative hash of the key.
        return ((h ^ d * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 >> 20 & 0xFFFFFFFFFFF) % self.n

    def find(self, key: bytes) -> int:
        """The only key that may equal ``key``; the caller compares."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self.key_at[-1 - d if d < 0 else self._slot(h, d)]


class Vocabulary:
    """Tokens by id, with both tiers of the look-up."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.whole = PerfectHash(tokens) if tokens else None
        missing = set(range(256)) - {t[0] for t in tokens if len(t) == 1}
        if missing:
            raise ValueError("the vocabulary lacks single bytes")

    @classmethod
    def load(cls, path: str, pattern: str) -> "Vocabulary":
        return cls(read_ranks(path), pattern)


def merge_bytes(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging neighbours, lowest rank first."""
    n, rank = len(piece), rank_of.get
    # One integer holds rank, start and stop of a possible token, in this order of weight.
    bits = n.bit_length()
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # end of the piece that starts at i; start of the one before
    heap = [(r << bits | i) << bits | i + 2 for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
    heapify(heap)
    low = (1 << bits) - 1
    while heap:
        top = heappop(heap)
        i, stop = top >> bits & low, top & low
        middle = end[i]
        if middle <= i or middle >= n or end[middle] != stop:
            continue  # one of the two pieces has changed since
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            if (r := rank(piece[i:end[stop]])) is not None:
                heappush(heap, (r << bits | i) << bits | end[stop])
        j = before[i]
        if j >= 0 and (r := rank(piece[j:stop])) is not None:
            heappush(heap, (r << bits | j) << bits | stop)
    ids, i = [], 0
    while i < n:
        ids.append(rank_of[piece[i:end[i]]])
        i = end[i]
    return ids


class Coder(dict):
    """Pre-token -> its ids as little-endian 32-bit integers, filled on demand.

    Two generations: when the young one is full it becomes the old one, and what is looked up moves back into the young one. So frequent
    pre-tokens stay, and those that come once are gone after a generation.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.rank_of = {t: i for i, t in enumerate(vocabulary.tokens)}
        self.split = regex.compile(vocabulary.pattern).findall
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            piece = word.encode()
            i = self.vocabulary.whole.find(piece)
            ids = [i] if self.vocabulary.tokens[i] == piece else merge_bytes(piece, self.rank_of)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if len(self) > MEMO:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder_of(shared: Shipped) -> Coder:
    """The worker's coder for a vocabulary; it keeps its memory from task to task."""
    return worker_cache("words", f"coder {shared.key}", lambda: Coder(shared.value))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Rows (``id_col``, n_tokens long[, ids array<int>]); a null text counts as empty, and repeated rows stay."""
    shared = Shipped(docs.sparkSession, vocabulary)

    def encode(rows: Iterator[tuple]):
        coder = coder_of(shared)
        for part in in_chunks(rows, 1):
            coded = [coder.encode(t or "") for _, t in part]
            out = {id_col: [r[0] for r in part], "n_tokens": [len(x) // 4 for x in coded]}
            if with_ids:
                out["ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in coded]
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_documents(docs, [id_col, text_col], f"{id_col} {kind}, n_tokens long" + ", ids array<int>" * with_ids, encode)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (``id_col``, decoded binary): the bytes of the ids. Null ids decode to no bytes."""
    shared = Shipped(encoded.sparkSession, vocabulary)

    def decode(rows: Iterator[tuple]):
        coder = coder_of(shared)
        for key, ids in rows:
            yield {id_col: [key], "decoded": [coder.decode(np.asarray(ids or [], "<u4").tobytes())]}

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_documents(encoded, [id_col, ids_col], f"{id_col} {kind}, decoded binary", decode)


def round_trip_digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
                       with_ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids again; of both only the length and the SHA-256 leave the task, and the ids if wanted.

    Returns ``id_col``, n_tokens long, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256, both as
    lowercase hex. A null text counts as empty: no tokens, digests of no bytes. Rows that repeat stay repeated.
    """
    shared = Shipped(docs.sparkSession, vocabulary)

    def digest(rows: Iterator[tuple]):
        coder = coder_of(shared)
        for part in in_chunks(rows, 1):
            out: dict[str, list] = {id_col: [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for key, text in part:
                ids = coder.encode(text or "")
                out[id_col].append(key)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    out.setdefault("ids", []).append(np.frombuffer(ids, "<i4"))
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_documents(docs, [id_col, text_col], schema, digest)
