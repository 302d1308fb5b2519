"""Byte-level BPE encoding and decoding by rank files, with a two-tier lookup.

A text is split by the vocabulary's pattern. First tier: a minimal perfect hash over the vocabulary's byte strings
resolves, in numpy over all distinct pieces of a batch, every piece that is a token as a whole. Second tier: what
misses is merged by a heap over a linked list of its bytes, lowest rank first, leftmost first among equals.

Workers hold the vocabulary and two arrays of its size, read from the rank file, whatever the corpus. No row is
shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, mixed, python_ready, text_of

# Keys of a bucket on average, when a perfect hash is built.
BUCKET_KEYS = 4
# Pieces of one round of lookups: a longer text is read in rounds, so memory follows this and not the text.
ROUND_PIECES = 200_000
# Merged pieces a worker remembers; the older half goes when that many are met.
MEMORY = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, one base64 string and one number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(key): int(rank) for key, rank in (line.split() for line in lines if line.strip())}


def _flat(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    return np.frombuffer(b"".join(keys), np.uint8), sizes


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each run of so many places."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def hashes(keys: list[bytes], multiplier: int) -> np.ndarray:
    """64-bit hashes of byte strings: a polynomial in ``multiplier`` over their bytes and length, finalized."""
    if not keys:
        return np.zeros(0, np.uint64)
    flat, sizes = _flat(keys)
    factors = np.full(int(sizes.max()) + 1, multiplier, np.uint64)
    factors[0] = 1
    powers = np.cumprod(factors, dtype=np.uint64)
    terms = (flat.astype(np.uint64) + np.uint64(1)) * powers[_within(sizes)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64) * powers[-1])


class PerfectHash:
    """Distinct byte strings to 0..n-1 without gaps, by hash and displace.

    Keys fall into buckets by their hash; from the largest bucket down, the first displacement that takes all keys of
    a bucket to free places is kept. A lookup is two array reads; whether a string is a key is told by comparing it
    with the key of its place.
    """

    def __init__(self, keys: list[bytes]):
        self.keys = keys
        self.n = len(keys)
        self.longest = max(map(len, keys), default=0)
        self.multiplier = 0x9E3779B97F4A7C15
        if len(set(keys)) < self.n:
            raise ValueError("the keys of a perfect hash must be distinct")
        while len(np.unique(h := self._hash(keys))) < self.n:
            self.multiplier += 2
        self.buckets = max(1, -(-self.n // BUCKET_KEYS))
        self.shift = np.zeros(self.buckets, np.uint64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        taken = np.zeros(self.n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] == 0:
                break
            self.shift[b] = self._displace(h[order[ends[b] - sizes[b] : ends[b]]], taken)
        self.key_at = np.empty(self.n, np.int64)
        self.key_at[self._place(h)] = np.arange(self.n)

    def _hash(self, keys: list[bytes]) -> np.ndarray:
        # A string of the longest key's length ends every call, so that the length term's power is always the same.
        return hashes([*keys, b"\0" * self.longest], self.multiplier)[: len(keys)]

    def _displace(self, h: np.ndarray, taken: np.ndarray) -> int:
        """The first displacement that takes ``h`` to free places, which are marked."""
        first, tries = 0, 8
        while True:
            shifts = np.arange(first, first + tries, dtype=np.uint64)
            places = (mixed(h[None, :] + shifts[:, None] * np.uint64(0xD1342543DE82EF95)) % np.uint64(self.n)).astype(np.int64)
            free = ~taken[places].any(axis=1)
            for k in np.flatnonzero(free):
                if len(set(places[k].tolist())) == len(h):
                    taken[places[k]] = True
                    return first + int(k)
            first, tries = first + tries, min(4 * tries, 1 << 15)

    def _place(self, h: np.ndarray) -> np.ndarray:
        shift = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        return (mixed(h + shift * np.uint64(0xD1342543DE82EF95)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Number of each string among the keys, -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        short = [k for k, key in enumerate(keys) if 0 < len(key) <= self.longest]
        if not short or not self.n:
            return out
        at = self.key_at[self._place(self._hash([keys[k] for k in short]))]
        for k, number in zip(short, at.tolist()):
            if self.keys[number] == keys[k]:
                out[k] = number
        return out


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of a piece: neighbours of the lowest rank merge first, the leftmost first among equals.

    The bytes are a doubly linked list; the heap holds neighbouring pairs as (rank, start, end). An entry whose span is
    no longer a pair of neighbours is stale and skipped.
    """
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if j <= i or j >= n or after[j] != end:
            continue
        # The right part leaves the list; its link back to itself marks it.
        after[i], after[j] = end, j
        if end < n:
            before[end] = i
            beyond = after[end]
            if (r := ranks.get(piece[i:beyond])) is not None:
                heappush(heap, (r, i, beyond))
        if (left := before[i]) >= 0 and (r := ranks.get(piece[left:end])) is not None:
            heappush(heap, (r, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encoding and decoding of many texts with one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        lacking = [b for b in range(256) if bytes([b]) not in self.ranks]
        if lacking:
            raise ValueError(f"the rank file has no token for bytes {lacking[:5]}")
        self.split = regex.compile(pattern)
        self.hash = PerfectHash(list(self.ranks))
        self.rank_of = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        self.merged: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}
        # Token bytes end to end, by id; an id that no token has is an empty string and refused.
        self.sizes = np.full(int(self.rank_of.max()) + 1, -1, np.int64)
        self.sizes[self.rank_of] = [len(k) for k in self.ranks]
        by_id = sorted(self.ranks, key=self.ranks.get)
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.starts = np.cumsum(np.maximum(self.sizes, 0)) - np.maximum(self.sizes, 0)

    def _miss(self, piece: bytes) -> list[int]:
        got = self.merged.get(piece)
        if got is None:
            if len(self.merged) > MEMORY // 2:
                self.merged, self.old = {}, self.merged
            got = self.old.get(piece) or merge_bytes(piece, self.ranks)
            self.merged[piece] = got
        return got

    def _round(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and how many each has."""
        code, distinct = coded(pieces)
        keys = [p.encode() for p in distinct]
        number = self.hash.find(keys)
        ids = [[]] * len(keys)
        for k in np.flatnonzero(number < 0):
            ids[k] = self._miss(keys[k])
        for k, rank in zip((found := np.flatnonzero(number >= 0)), self.rank_of[number[found]].tolist()):
            ids[k] = [rank]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for own in ids for i in own), np.uint32, int(sizes.sum()))
        return flat[_gather(np.cumsum(sizes) - sizes, sizes, code)], sizes[code]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers, looked up in rounds of many texts or of parts of a long one."""
        pieces: list[str] = []
        ends: list[int] = []  # of the texts that end among the pieces
        held: list[np.ndarray] = []  # what the first of them had in earlier rounds
        for text in texts:
            if len(text) < ROUND_PIECES:
                pieces += self.split.findall(text)
            else:
                for found in self.split.finditer(text):
                    pieces.append(found[0])
                    if len(pieces) >= ROUND_PIECES:
                        whole, begun = self._close(pieces, ends, held)
                        yield from whole
                        held = [begun] if ends else [*held, begun]
                        pieces, ends = [], []
            ends.append(len(pieces))
            if len(pieces) >= ROUND_PIECES:
                yield from self._close(pieces, ends, held)[0]
                pieces, ends, held = [], [], []
        yield from self._close(pieces, ends, held)[0]

    def _close(self, pieces: list[str], ends: list[int], held: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of the texts that end among the pieces, and those of the text begun after them."""
        ids, sizes = self._round(pieces) if pieces else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        *whole, begun = np.split(ids, np.concatenate([[0], np.cumsum(sizes)])[ends])
        if whole and held:
            whole[0] = np.concatenate([*held, whole[0]])
        return whole, begun

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64, copy=False)
        if len(ids) and (ids.max() >= len(self.sizes) or self.sizes[ids].min() < 0):
            raise ValueError("an id that the rank file does not have")
        return self.token_bytes[_gather(self.starts, np.maximum(self.sizes, 0), ids)].tobytes()


def _gather(starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the chosen stretches, end to end."""
    size = sizes[chosen]
    return np.repeat(starts[chosen], size) + _within(size)


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per worker process, rank file and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            ids = [x.astype("<u4").tobytes() for x in c.encode(b.column("text").to_pylist())]
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), sizes, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            out = [c.decode(np.frombuffer(x.as_py(), "<u4")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) of every row's whole text.

    ``path``: rank file, with a token for every byte. ``pattern`` splits texts; each match is encoded by itself, what it
    doesn't match is left out, as the library of such files does. Strings of special tokens are ordinary text.

    A null text is an empty one, without ids. A null doc_id stays null; rows of equal ids and repeated rows are encoded
    each. Texts of any length are read whole, in rounds of ``ROUND_PIECES``. An empty table gives no rows. Other columns
    are not read.
    """
    python_ready(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return given.mapInArrow(_encode(path, pattern), "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of :func:`encode` with ``decoded``, the bytes of the ids. No ids are no bytes; an unknown id is an error.

    Decoded bytes are those of the text wherever the pattern matches all of it.
    """
    python_ready(tokens.sparkSession)
    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(
        _decode(path, pattern), "doc_id long, n_tokens long, ids binary, decoded binary"
    )
