"""Token-id files with an adaptive context-mixing range coder (operator 7).

Texts are encoded by the tokenizers library (asked once for a word that a worker
process meets again, see :class:`Words`), an end id is appended to each, and the
ids are written in ascending doc_id order. Ids are cut into blocks of ``BLOCK``
ids; every block starts from a fresh model, ends with a flush and carries the
CRC-32 of its ids, so a damaged block is found and harms no other.

Model of a block, all in whole numbers so that any machine decodes the same:

* order 2: the id that last followed the same two ids, with a confidence;
* order 1: the id that last followed the same id, with a confidence;
* order 0: how often each id was seen.

The order-2 id is the prediction where it was right before or order 1 has none,
else the order-1 id. "Is it the predicted id?" is a binary decision whose
probability mixes the adaptive estimates of all three orders in the logistic
domain by weights that are learned on the way. An id that was not predicted is
coded by its share of order 0. Every id thus goes through the range coder in one
step; nothing is stored beside it.

The coder keeps 48 bits of the range's low end and gives out 16 at a time. A
carry is added to the word before; carries that run on are settled at the end.

A block's ids are dealt to lanes of ``LANE`` consecutive ones at most, each with
a range of its own, that share the block's model: a step codes the next id of
every lane with a few array operations, by what the steps before it have taught.
What followed is learned after every step, estimates and weights after
``EVERY`` and shares after ``EVERY0`` steps (sooner at the beginning). A task
holds one chunk of about ``CHUNK`` ids at a time.

Files are written by the tasks under unique names; only those in the manifest
(a Spark table) are read back. A chunk is read by one task, wherever it runs.

Defined results: null text is the empty text (its only id is the end id); a
null doc_id comes after all others; rows that share a doc_id follow each other
by their first ``PREFIX`` characters, then as they stand in the table; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, numbered, spread, table

BLOCK = 1 << 20  # ids
LANE = 256  # ids a lane
CHUNK = 8_000_000
PREFIX = 64
MAGIC = b"TID2"
LAST = (1 << 63) - 1  # place of a null doc_id
END_ID = 0
SLICE = 4 << 20  # bytes of text that are encoded at a time, or one text

SYMBOLS = 1 << 16
PAIRS = 1 << 16  # places of order 2, a power of two
BITS0 = 19
TOTAL0 = 1 << BITS0  # what the shares of order 0 sum up to at most
NEW = 1024  # ids not seen yet count as so many seen ones together
#: Steps between two counts of order 0, and between two of the mixer, once as many are coded.
EVERY0, EVERY = 128, 8
#: The coder's range: at most 2^48, and never below 2^32 when an id is coded (whose part may be 2^-25 of it).
FULL, TOP, LOW32 = 1 << 48, 1 << 32, (1 << 32) - 1
# logistic tables: 12-bit probabilities and their logits in 1/256
_logit = np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))
STRETCH = np.rint(_logit * 256).astype(np.int64)
SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 1, 4095).astype(np.int64)
#: What a confidence of 0 to 7 gains when its id follows again, and loses (by half) when another does.
GAIN = np.array([1, 1, 1, 1, 1, 1, 1, 0], dtype=np.int32)
MOVE = np.concatenate([(np.arange(8) >> 1) - np.arange(8), GAIN]).astype(np.int32)
#: How common an id is by its share / 64: 0 below 64, then one more whenever that doubles, up to 7.
LEVEL = np.array([n.bit_length() for n in range(65)], dtype=np.int32)


def turned(table: np.ndarray) -> np.ndarray:
    """The transposed table as one of its own, 64 columns at a time, which is what a processor's cache holds."""
    out = np.empty(table.shape[::-1], dtype=table.dtype)
    for i in range(0, table.shape[1], 64):
        for j in range(0, table.shape[0], 512):
            out[i:i + 64, j:j + 512] = table[j:j + 512, i:i + 64].T
    return out


class Encoder:
    """Range coder over many blocks at once."""

    def __init__(self, blocks: int):
        self.low = np.zeros(blocks, dtype=np.int64)
        self.range = np.full(blocks, FULL, dtype=np.int64)
        self.at = np.zeros(blocks, dtype=np.int64)
        # words of 16 bits; a carry may make one larger. Blocks go on alike: their words of a place lie together
        self.out = np.zeros((LANE + 8, blocks), dtype=np.int32).T
        self.most = 0  # at most so many words are in any block

    def narrow(self, of: np.ndarray, each: np.ndarray, below: np.ndarray, count: np.ndarray) -> None:
        """Narrow the range to ``count`` parts of size ``each``, ``below`` of them left out before."""
        self.take(of, each * below, each * count)

    def take(self, of: np.ndarray | slice, below: np.ndarray, width: np.ndarray) -> None:
        """``of``: numbers, or a slice from the first on."""
        low = self.low[of] + below
        over = np.flatnonzero(low >= FULL)
        if len(over):
            who = over if isinstance(of, slice) else of[over]
            self.out.T.reshape(-1)[(self.at[who] - 1) * len(self.out) + who] += 1
            low[over] -= FULL
        small = np.flatnonzero(width < TOP)
        while len(small):
            who = small if isinstance(of, slice) else of[small]
            at = self.at[who]
            self.most += 1
            if self.most > self.out.shape[1] - 4:
                self.most = int(self.at.max()) + 1
                if self.most > self.out.shape[1] - 4:
                    self.out = np.concatenate([self.out.T, np.zeros_like(self.out.T)]).T
            own = low[small]
            self.out.T.reshape(-1)[at * len(self.out) + who] = own >> 32
            self.at[who] = at + 1
            low[small] = (own & LOW32) << 16
            wider = width[small] << 16
            width[small] = wider
            small = small[wider < TOP]
        self.low[of], self.range[of] = low, width

    def code(self, of: slice, p: np.ndarray, shares: Shares, hit: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code whether an id is the predicted one (probability ``p`` / 65,536) and, if not, its share of order 0."""
        held = self.range[of]
        part = (held >> 16) * p
        each = (held - part) >> BITS0
        below, share = shares.of(ids)
        self.take(of, np.where(hit, 0, part + each * below), np.where(hit, part, each * share))
        return hit, ids

    def finish(self) -> None:
        self.out = turned(self.out.T[:self.at.max() + 3])
        every = np.arange(len(self.low))
        for shift in (32, 16, 0):
            self.out[every, self.at] = (self.low >> shift) & 65535
            self.at += 1
        while True:
            block, word = np.nonzero(self.out > 65535)
            if not len(block):
                return
            self.out[block, word] -= 65536
            self.out[block, word - 1] += 1


class Decoder:
    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([turned(words), np.zeros((4, len(words)), dtype=np.int32)])  # those of a place together
        first = self.words[:3].astype(np.int64)
        self.value = (first[0] << 32) | (first[1] << 16) | first[2]
        self.range = np.full(len(words), FULL, dtype=np.int64)
        self.at = np.full(len(words), 3, dtype=np.int64)

    def narrow(self, of: np.ndarray, each: np.ndarray, below: np.ndarray, count: np.ndarray) -> None:
        self.take(of, each * below, each * count)

    def take(self, of: np.ndarray | slice, below: np.ndarray, width: np.ndarray) -> None:
        value = self.value[of] - below
        small = np.flatnonzero(width < TOP)
        while len(small):
            who = small if isinstance(of, slice) else of[small]
            at = np.minimum(self.at[who], len(self.words) - 1)  # a damaged block may ask for more
            value[small] = ((value[small] & LOW32) << 16) | self.words.reshape(-1)[at * self.words.shape[1] + who]
            self.at[who] = at + 1
            wider = width[small] << 16
            width[small] = wider
            small = small[wider < TOP]
        self.value[of], self.range[of] = value, width

    def code(self, of: slice, p: np.ndarray, shares: Shares, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held, value = self.range[of], self.value[of]
        part = (held >> 16) * p
        each = (held - part) >> BITS0
        hit = value < part
        # exact: whole numbers below 2^48 whose quotient is below 2^20; a damaged block may lie outside
        place = np.minimum(np.maximum((value - part) / each, 0), TOTAL0 - 1).astype(np.int64)
        ids = np.where(hit, guess, shares.at.take(place))
        below, share = shares.of(ids)
        self.take(of, np.where(hit, 0, part + each * below), np.where(hit, part, each * share))
        return hit, ids


class Shares:
    """Order 0: every id's part of ``TOTAL0``, by how often it was seen in the block when last counted."""

    def __init__(self, decode: bool):
        self.decode = decode
        self.counts = np.zeros(SYMBOLS, dtype=np.int64)
        self.count(np.zeros(0, dtype=np.int64))

    def count(self, ids: np.ndarray) -> None:
        self.counts += np.bincount(ids, minlength=SYMBOLS)
        seen, free = int(self.counts.sum()), TOTAL0 - SYMBOLS
        share = 1 + self.counts * free // (seen + NEW) + (free * NEW // (seen + NEW) >> 16)
        ends = np.cumsum(share)
        self.both = (ends - share) << 20 | share
        # 0 to 7: how common an id is as a prediction; place 0 is that of no prediction
        self.level = np.zeros(SYMBOLS + 1, dtype=np.int32)
        self.level[1:] = LEVEL.take(share >> 6, mode="clip")
        if self.decode:
            self.at = np.full(TOTAL0, SYMBOLS - 1, dtype=np.uint16)
            self.at[:ends[-1]] = np.repeat(np.arange(SYMBOLS, dtype=np.uint16), share)

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of all shares before each id's, and its own."""
        both = self.both.take(ids)
        return both >> 20, both & (1 << 20) - 1


class Mixer:
    """Estimates of three orders and their learned weights for "is it the predicted id?", a probability for each
    triple of their contexts (16, 16 and 8). Both are learned from what was counted since the last time."""

    SHAPE = (16, 16, 8)

    def __init__(self):
        self.hits, self.all = [[np.full(n, x, dtype=np.int64) for n in self.SHAPE] for x in (1, 2)]
        self.weights = [22000] * 3
        self.mix()

    def mix(self) -> None:
        self.logits = []
        for k, n in enumerate(self.SHAPE):
            form = [1, 1, 1]
            form[k] = n
            self.logits.append(STRETCH[self.hits[k] * 4095 // self.all[k]].reshape(form))
        mixed = sum(w * x for w, x in zip(self.weights, self.logits)) >> 16
        self.p = SQUASH[np.minimum(np.maximum(mixed, -2047), 2047) + 2047]
        # never so sure that a part of what is left gets too small for order 0
        self.chance = np.minimum(self.p << 4, 65536 - 1024).reshape(-1)

    def learn(self, contexts: np.ndarray, hit: np.ndarray) -> None:
        every = np.bincount(contexts, minlength=2048).reshape(self.SHAPE)
        right = np.bincount(contexts[hit], minlength=2048).reshape(self.SHAPE)
        error = right * 4096 - every * self.p
        for k, logits in enumerate(self.logits):
            step = int((error * logits).sum()) // len(contexts)
            self.weights[k] = min(max(self.weights[k] + (step * 24 >> 10), 0), 1 << 17)
            others = tuple(j for j in range(3) if j != k)
            self.hits[k] += right.sum(axis=others)
            self.all[k] += every.sum(axis=others)
            old = self.all[k] > 1 << 16  # what lies far back counts less
            self.hits[k][old] >>= 1
            self.all[k][old] >>= 1
        self.mix()


def lanes(count: int) -> tuple[int, int]:
    """How many lanes a block of ``count`` ids has, and how many ids each (the last may have fewer)."""
    n = -(-count // LANE)
    length = -(-count // n)
    return -(-count // length), length


def coded(coder, count: int, ids: np.ndarray | None) -> np.ndarray:
    """Run the model over a block; ``ids`` are given when encoding and returned when decoding."""
    n, length = lanes(count)
    encode = ids is not None
    grid = np.zeros((n, length), dtype=np.int32)
    if encode:
        grid.reshape(-1)[:count] = ids
    grid = turned(grid)
    # what followed last: (id + 1) * 8 + confidence; 0: nothing yet
    after2, after1 = np.zeros(PAIRS, dtype=np.int32), np.zeros(SYMBOLS, dtype=np.int32)
    shares, mixer = Shares(not encode), Mixer()
    last, older = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    final, counted, learned = count - (n - 1) * length, 0, 0
    contexts, hits = [], []
    for step in range(length):
        m = n if step < final else n - 1
        of = slice(0, m)
        last, older = last[:m], older[:m]
        pair = (last * 40503 + older * 30011) & (PAIRS - 1)
        held1, held2 = after1.take(last), after2.take(pair)
        sure1, sure2, guess1, guess2 = held1 & 7, held2 & 7, held1 >> 3, held2 >> 3
        by2 = (sure2 > 0) | ((held1 == 0) & (held2 > 0))
        guess = np.where(by2, guess2, guess1)
        context = sure2 << 7 | by2.astype(np.int32) << 10 | sure1 << 3 | (guess1 == guess2).astype(np.int32) << 6 | shares.level.take(guess)
        guess -= 1
        chance = mixer.chance.take(context)
        if encode:
            value = grid[step, :m].astype(np.int64)
            hit, _ = coder.code(of, chance, shares, value == guess, value)
        else:
            hit, value = coder.code(of, chance, shares, guess)
            grid[step, :m] = value

        found = grid[step, :m] + np.int32(1)
        anew = found << 3
        after2[pair] = np.where(guess2 == found, held2 + GAIN.take(sure2), anew)
        right = guess1 == found
        after1[last] = np.where(right | (sure1 > 1), held1 + MOVE.take(sure1 | right.astype(np.int32) << 3), anew)
        older, last = last, value

        contexts.append(context)
        hits.append(hit)
        done = step + 1
        if done - learned >= min(EVERY, done - done // 2):
            mixer.learn(np.concatenate(contexts), np.concatenate(hits))
            contexts, hits, learned = [], [], done
        if done - counted >= min(EVERY0, done - done // 2) and done < length:
            shares.count(grid[counted:done].reshape(-1) if done <= final else np.concatenate([grid[counted:done, :n - 1].reshape(-1), grid[counted:final, n - 1]]))
            counted = done
    return turned(grid).reshape(-1)[:count]


def packed(ids: np.ndarray) -> bytes:
    """The blocks of an id sequence (below 65,536) as bytes."""
    parts = []
    for at in range(0, len(ids), BLOCK):
        own = ids[at:at + BLOCK]
        coder = Encoder(lanes(len(own))[0])
        coded(coder, len(own), own)
        coder.finish()
        words = coder.out[np.arange(coder.out.shape[1]) < coder.at[:, None]].astype("<u2")
        parts += [struct.pack("<III", zlib.crc32(own.astype("<u4").tobytes()), len(own), len(words)),
                  coder.at.astype("<u4").tobytes(), words.tobytes()]
    return b"".join(parts)


def unpacked(data: bytes) -> np.ndarray:
    """The ids of :func:`packed` bytes; ValueError if a block's checksum fails."""
    at, parts = 0, [np.zeros(0, dtype=np.int32)]
    while at < len(data):
        check, count, size = struct.unpack_from("<III", data, at)
        n = lanes(count)[0] if 0 < count <= BLOCK else 0
        at += 12 + 4 * n + 2 * size
        if not n or at > len(data):
            raise ValueError("the head of a block of token ids is damaged")
        sizes = np.frombuffer(data, "<u4", n, at - 2 * size - 4 * n).astype(np.int64)
        if sizes.sum() != size or sizes.min() < 3:
            raise ValueError("the head of a block of token ids is damaged")
        words = np.zeros((n, sizes.max()), dtype=np.int32)
        words[np.arange(sizes.max()) < sizes[:, None]] = np.frombuffer(data, "<u2", size, at - 2 * size)
        own = coded(Decoder(words), count, None)
        if zlib.crc32(own.astype("<u4").tobytes()) != check:
            raise ValueError("a block of token ids is damaged")
        parts.append(own)
    return np.concatenate(parts)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The library's tokenizer of a file, once per worker process; special tokens in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """The words of a tokenizer file met so far, once per worker process."""
    return Words(path)


class Words:
    """Ids of texts by the library, which is asked once for a word that returns.

    A text is cut before every space and newline. The byte-level pattern never joins what stands before such a cut
    with what follows, whatever these are, as long as no more than two blanks follow each other (one at the end of
    the text); so the ids of the words, in order, are those of the text. Texts with longer blanks, or with other
    characters that an engine may hold for blanks, go to the library whole.

    Words that were met are kept in arrays: their bytes, their ids, and their places in the order of a 64-bit hash.
    A word is known by its bytes; the hash only says where to look.
    """

    MOST, LETTERS = 2_000_000, 1 << 26  # words kept (three quarters of them, the last met, stay), and their bytes
    LONG = 256  # bytes from which on a word is not kept
    POWERS = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15, dtype=np.uint64))
    JOINED = 300  # words that the library gets in one text
    WHOLE = "[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]|[ \n]{2}(?:[ \n]|\\z)"
    NONE, END = 0, 1  # places of no ids, and of the end id

    def __init__(self, path: str):
        self.own = tokenizer(path)
        # in the byte-level alphabet these are a space and a newline
        self.opens = np.zeros(SYMBOLS, dtype=bool)
        self.opens[[i for token, i in self.own.get_vocab().items() if token[0] in "\u0120\u010a"]] = True
        self.now = 0
        self.forget()

    def forget(self) -> None:
        # by place: a word without its blank or with its newline, or a space and a text's first word; the end (in bytes) of its ids
        self.words = pa.array(["", ""], pa.large_string())
        self.ids, self.ends = np.array([END_ID], dtype=np.int32), np.array([0, 0, 4], dtype=np.int64)
        self.met = np.zeros(2, dtype=np.int32)  # when it was last asked for
        self.hashes, self.places = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.letters = 0

    def keep_latest(self) -> None:
        """Forget the words that were not met for longest."""
        many = len(self.met) - 2 - self.MOST * 3 // 4
        stays = np.ones(len(self.met), dtype=bool)
        stays[2 + np.argpartition(self.met[2:], many)[:many]] = False
        held = np.flatnonzero(stays)
        index = stays[self.places]
        self.hashes, self.places = self.hashes[index], (np.cumsum(stays) - 1)[self.places[index]]
        self.words = self.words.take(pa.array(held))
        self.ids, self.ends = self.gathered(held)
        self.met = self.met[held]
        self.letters = pc.sum(pc.binary_length(self.words)).as_py()

    def gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some places, and where each one's end (in bytes, from 0)."""
        pool = pa.Array.from_buffers(pa.large_binary(), len(self.ends) - 1, [None, pa.py_buffer(self.ends), pa.py_buffer(self.ids)])
        got = pool.take(pa.array(places)).buffers()
        ends = np.frombuffer(got[1], np.int64, len(places) + 1).copy()
        return np.frombuffer(got[2], np.int32, ends[-1] // 4).copy(), ends

    def asked(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(got.ids, dtype=np.int32) for got in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def add(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> int:
        """Append the ids of some words or texts; the place of the first."""
        first = len(self.ends) - 1
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + 4 * np.cumsum(np.concatenate(sizes))])
        return first

    def learn(self, words: pa.Array) -> np.ndarray:
        """Ask the library for words that were not met yet; the number of each, in the order of their new places."""
        keys = words.to_numpy(zero_copy_only=False).tolist()
        bare = pc.or_(pc.is_in(words, pa.array(["", "\n"], pa.large_string())), pc.starts_with(words, " ")).to_numpy(zero_copy_only=False)
        joined, alone = np.flatnonzero(~bare), [np.flatnonzero(bare)]
        met, ids, sizes = [], [], []
        parts = [joined[i:i + self.JOINED] for i in range(0, len(joined), self.JOINED)]
        for i in range(0, len(parts), 64):
            some = parts[i:i + 64]
            for part, got in zip(some, self.asked([self.text([keys[k] for k in part.tolist()]) for part in some])):
                starts = np.flatnonzero(self.opens[got])
                if len(starts) == len(part) and starts[0] == 0:
                    met.append(part)
                    ids.append(got)
                    sizes.append(np.diff(starts, append=len(got)))
                else:
                    alone.append(part)
        alone = np.concatenate(alone)
        for i in range(0, len(alone), 1024):
            some = [keys[k] for k in alone[i:i + 1024].tolist()]
            got = self.asked([key[1:] if key[:1] == " " else self.text([key]) for key in some])
            met.append(alone[i:i + 1024])
            ids += got
            sizes.append(np.array([len(x) for x in got]))
        self.add(ids, sizes)
        return np.concatenate(met)

    @staticmethod
    def text(keys: list[str]) -> str:
        return (" " + " ".join(keys)).replace(" \n", "\n")

    def hashed(self, words: pa.Array) -> np.ndarray:
        """A sum of each word's bytes times powers of an odd number, modulo 2^64."""
        found = [np.zeros(0, dtype=np.uint64)]
        for i in range(0, len(words), 1 << 13):
            some = words[i:i + (1 << 13)]
            _, ends, data = some.buffers()
            ends = np.frombuffer(ends, np.int64)[some.offset:some.offset + len(some) + 1]
            size = np.diff(ends)
            data = np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.uint8)
            place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)
            sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * self.POWERS[place], dtype=np.uint64))
            sums = sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]
            found.append(sums ^ sums >> np.uint64(31))
        return np.concatenate(found)

    def found(self, words: pa.Array) -> np.ndarray:
        """The places of words, no two alike."""
        hashes = self.hashed(words)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        near = np.flatnonzero(at < len(self.hashes))
        near = near[self.hashes[at[near]] == hashes[order[near]]]
        places = np.full(len(words), self.NONE)
        if len(near):
            held = self.places[at[near]]
            same = pc.equal(self.words.take(pa.array(held)), words.take(pa.array(order[near]))).to_numpy(zero_copy_only=False)
            places[order[near[same]]] = held[same]
        new = np.flatnonzero(places == self.NONE)
        if len(new):
            first = len(self.met)  # as new places begin
            new = new[self.learn(words.take(pa.array(new)))]
            places[new] = np.arange(first, first + len(new))
            self.words = pa.concat_arrays([self.words, words.take(pa.array(new))])
            self.met = np.append(self.met, np.zeros(len(new), dtype=np.int32))
            free = np.ones(len(words), dtype=bool)
            free[order[near]] = False  # another word has its hash: it is asked for again
            new = order[free[order] & (places[order] >= first)]
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes, self.places = np.insert(self.hashes, at, hashes[new]), np.insert(self.places, at, places[new])
            self.letters += pc.sum(pc.binary_length(words.take(pa.array(new)))).as_py() or 0
        self.met[places] = self.now
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none null), an end id after each, and how many each text has."""
        self.now += 1
        if self.letters > self.LETTERS:
            self.forget()
        elif len(self.met) - 2 > self.MOST:
            self.keep_latest()
        texts = texts.cast(pa.large_string())
        whole = pc.match_substring_regex(texts, self.WHOLE)
        cuts = pc.split_pattern(pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n"), " ")
        at = cuts.offsets.to_numpy()
        at, pieces = at - at[0], cuts.flatten()
        # a text's first piece has no blank before it
        later = np.ones(len(pieces), dtype=bool)
        later[at[:-1]] = False
        none, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        first = pc.binary_join_element_wise(blank, pieces.take(pa.array(at[:-1])), none).dictionary_encode()
        coded = pieces.filter(pa.array(later)).dictionary_encode()
        words = pa.concat_arrays([coded.dictionary, first.dictionary])
        short = pc.less(pc.binary_length(words), self.LONG).to_numpy(zero_copy_only=False)
        own = np.empty(len(words), dtype=np.int64)
        own[short] = self.found(words.filter(pa.array(short)))
        known = len(self.ends), len(self.ids)
        if not short.all():
            long, start = np.flatnonzero(~short), len(self.ends) - 1
            own[long[self.learn(words.take(pa.array(long)))]] = np.arange(start, start + len(long))
        place = np.empty(len(pieces), dtype=np.int64)
        place[later] = own[coded.indices.to_numpy()]
        place[at[:-1]] = own[len(coded.dictionary) + first.indices.to_numpy()]
        whole = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        for i in range(0, len(whole), 64):
            some = whole[i:i + 64]
            got = self.asked(texts.take(pa.array(some)).to_pylist())
            start = self.add(got, [np.array([len(x) for x in got])])
            place[at[some]] = np.arange(start, start + len(some))
        ids, ends = self.gathered(np.insert(place, at[1:], self.END))
        self.ends, self.ids = self.ends[:known[0]], self.ids[:known[1]]  # whole texts and long words are not kept
        return ids, np.diff(ends[at[1:] + np.arange(1, len(texts) + 1)] // 4, prepend=0)


def written(docs: DataFrame, tokenizer_path: str, folder: str) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; the manifest
    ``(part, chunk, path, offset, length, ids)``, a row per chunk."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(tokenizer_path)
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"part-of-ids-{part:06d}-{uuid.uuid4().hex}.tids"
        sink, rows, offset = None, [], 0
        docs_in, counts, ids = [], [], []
        size = 0

        def chunk() -> None:
            nonlocal sink, offset, docs_in, counts, ids, size
            if sink is None:
                sink = store.open_output_stream(f"{root}/{name}", compression=None)
            index = np.concatenate(docs_in + counts).astype("<i8").tobytes()
            body = packed(np.concatenate(ids))
            data = MAGIC + struct.pack("<IQI", len(index) // 16, len(body), zlib.crc32(index)) + index + body
            sink.write(data)
            rows.append({"part": part, "chunk": len(rows), "path": f"{folder}/{name}", "offset": offset,
                         "length": len(data), "ids": size})
            offset += len(data)
            docs_in, counts, ids, size = [], [], [], 0

        for batch in batches:
            far = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(far):
                limit = SLICE + (far[begin - 1] if begin else 0)
                end = max(begin + 1, int(np.searchsorted(far, limit, "right")))
                mine, many = own.encode(batch.column(1).slice(begin, end - begin))
                docs_in.append(batch.column(0).slice(begin, end - begin).to_numpy())
                counts.append(many)
                ids.append(mine)
                size += len(mine)
                begin = end
                if size >= CHUNK:
                    chunk()
        if docs_in:
            chunk()
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("part", pa.int32()), ("chunk", pa.int32()), ("path", pa.string()), ("offset", pa.int64()),
                 ("length", pa.int64()), ("ids", pa.int64())]))

    rows = numbered(docs).select(F.coalesce(F.col("whole.doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                                 F.coalesce(F.col("whole.text").cast("string"), F.lit("")).alias("text"), "row")
    # rows without an id, or of one id, are dealt out by their beginnings and numbers
    order = ("doc", F.substring("text", 1, PREFIX), "row")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")
    return cut(ordered.mapInArrow(per_task, "part int, chunk int, path string, offset long, length long, ids long"), "ids-manifest")


def read_back(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    before = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1))
    chunks = manifest.withColumn("before", F.coalesce(before, F.lit(0)))  # one row per chunk

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, at = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(at) as file:
                    file.seek(row["offset"])
                    data = file.read(row["length"])
                count, size, check = struct.unpack_from("<IQI", data, 4)
                index = data[20:20 + 16 * count]
                if data[:4] != MAGIC or zlib.crc32(index) != check:
                    raise ValueError("the index of a chunk of token ids is damaged")
                docs, counts = np.frombuffer(index, dtype="<i8").reshape(2, count)
                ids = unpacked(data[20 + 16 * count:20 + 16 * count + size]).astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([None if d == LAST else int(d) for d in docs], pa.int64()),
                    "start": pa.array(starts + row["before"]), "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())})

    return spread(chunks, "part", "chunk").mapInArrow(per_task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark, sf_dir):
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return read_back(written(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder))
