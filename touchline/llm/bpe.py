"""Byte-level BPE encoding and decoding (operator 2).

A text is cut by the vocabulary's split pattern. Each pre-token goes through
two tiers: a minimal perfect hash over the vocabulary resolves a pre-token that
is itself a vocabulary entry; any other is merged by a heap of candidate pairs
over a linked list of its bytes, lowest rank first and leftmost among equals.

The hash is hash-and-displace: keys fall into buckets by one hash, and each
bucket takes the first displacement that sends all its keys to free slots. It
has exactly one slot a key; a lookup compares the slot's key, so strings
outside the vocabulary are refused.

Work is per document and needs no shuffle. A worker process holds the tables
of one rank file and a memo of recent pre-tokens, none of them long, that is
emptied at a fixed size, so memory does not grow with the data.

Defined results: a null text is the empty text and has no ids; any string
round-trips, as every byte is in the vocabulary; repeated rows come back once
per row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import let_workers_import

#: Pre-tokens kept in the memo, and the most bytes of one that is kept.
MEMO_SIZE, MEMO_BYTES = 400_000, 64
KEYS_A_BUCKET = 4
#: Of Unicode white space, what the pattern's ``\s`` means to the reference tokenizer library.
SPACE = r"\p{White_Space}"


class PerfectHash:
    """Minimal perfect hash from byte strings to their numbers."""

    def __init__(self, numbers: dict[bytes, int]):
        size = len(numbers)
        self.size = size
        self.buckets = max(1, size // KEYS_A_BUCKET)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * size
        self.values = [0] * size
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in numbers:
            groups[xxhash.xxh3_64_intdigest(key) % self.buckets].append(key)
        for bucket in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            group = groups[bucket]
            seed = 0
            while group:
                seed += 1
                slots = [xxhash.xxh64_intdigest(key, seed) % size for key in group]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    for slot, key in zip(slots, group):
                        self.keys[slot], self.values[slot] = key, numbers[key]
                    break
            self.shift[bucket] = seed

    def get(self, key: bytes) -> int | None:
        seed = self.shift[xxhash.xxh3_64_intdigest(key) % self.buckets]
        if not seed:
            return None
        slot = xxhash.xxh64_intdigest(key, seed) % self.size
        return self.values[slot] if self.keys[slot] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by successive merges: a heap of (rank, left place)
    over linked parts. A popped pair counts only if both parts still are what
    they were when it was pushed."""
    n = len(piece)
    end = list(range(1, n + 1))       # where the part that starts here ends; 0: merged away
    before = list(range(-1, n - 1))   # start of the part to the left
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapify(heap)
    while heap:
        _, left, stop = heappop(heap)
        middle = end[left]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[left], end[middle] = stop, 0
        if stop < n:
            before[stop] = left
            rank = ranks.get(piece[left:end[stop]])
            if rank is not None:
                heappush(heap, (rank, left, end[stop]))
        if left:
            first = before[left]
            rank = ranks.get(piece[first:stop])
            if rank is not None:
                heappush(heap, (rank, first, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:end[at]]])
        at = end[at]
    return out


class Codec(dict):
    """Encoder and decoder of one rank file; the dict itself is the memo from
    pre-token to ids."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(key): int(rank) for key, rank in map(bytes.split, lines)}
        self.whole = PerfectHash(self.ranks)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for key, rank in self.ranks.items():
            self.bytes_of[rank] = key
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", SPACE)
                                   .replace(r"\S", rf"\P{{White_Space}}")).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMO_SIZE:
            self.clear()
        raw = piece.encode()
        found = self.whole.get(raw)
        ids = (found,) if found is not None else tuple(merge(raw, self.ranks))
        if len(raw) <= MEMO_BYTES:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, once per worker process."""
    return Codec(path, pattern)


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids array<int>)``, a row per document."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            ids = [own.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(per_batch, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, text binary)`` from ``(doc_id, ids)``."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            texts = [own.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(per_batch, "doc_id long, text binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, and ``ids`` if asked
    for: each text encoded, its ids decoded again, both digested in the same pass."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        decimal = own.text_of.__getitem__
        for batch in batches:
            counts, of_ids, of_bytes, kept = [], [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids))
                if with_ids:
                    kept.append(np.array(ids, dtype=np.int32))
                of_ids.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _rows(docs).mapInArrow(per_batch, schema + (", ids array<int>" if with_ids else ""))


def _rows(docs: DataFrame) -> DataFrame:
    let_workers_import(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .common import table

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN)
