"""Packing along a space-filling curve.

Every document is tokenized and turned into a hashed vector of its ids; a fixed random projection takes the vector to
a few dimensions, and its cell on a Hilbert curve is the sort key. Documents are range-sorted by that key and laid end
to end along the curve, so documents that share vocabulary become neighbours, and the line of ids is cut every
``length`` ids. Only the last sequence of a corpus has padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, in_order, keep, mixed, parts_of, python_ready, text_of
from .tokens import END_ID, TEXT_ROWS, encode_all, vocabulary_size

LENGTH = 4096
FEATURES = 512
DIMENSIONS = 4
BITS = 12
SEED = 1


def hashed_vectors(ids: list[np.ndarray]) -> np.ndarray:
    """One unit vector per document: log counts of its ids, hashed to ``FEATURES`` places."""
    if not ids:
        return np.zeros((0, FEATURES))
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    place = (mixed(np.concatenate(ids)) >> np.uint64(32)).astype(np.int64) % FEATURES
    counts = np.bincount(row * FEATURES + place, minlength=len(ids) * FEATURES).reshape(len(ids), FEATURES)
    v = np.log1p(counts)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def cells(vectors: np.ndarray, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Integer coordinates of the vectors' projections; the logistic curve spreads them over the grid."""
    plane = np.random.default_rng(SEED).standard_normal((vectors.shape[1], dimensions))
    spread = 1 / (1 + np.exp(-1.7 * (vectors @ plane)))
    return np.minimum((spread * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each integer point on the Hilbert curve of its grid.

    From the highest bit plane down: the part of the cube a point lies in says how the finer planes are turned
    (two axes swap) or mirrored (lower bits of one axis flip); Gray decoding then gives the part's rank.
    """
    x = points.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for axis in range(n):
            inside = (x[axis] >> level) & 1 == 1
            swap = np.where(inside, 0, (x[0] ^ x[axis]) & lower)
            x[0] = np.where(inside, x[0] ^ lower, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


_CODED = "doc_id long, no_id boolean, ids binary, doc_tokens long"


def _tokenize(path: str, end_id: int, narrow: str):
    """Ids in the ``narrow`` integers they are shuffled in, and the document's place on the curve."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = encode_all(path, b["text"], end_id)
            ids = [np.frombuffer(x, "<u4") for x in got]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"], "no_id": b["no_id"], "ids": [x.astype(narrow).tobytes() for x in ids],
                    "doc_tokens": [len(x) for x in ids], "key": hilbert_keys(cells(hashed_vectors(ids))),
                }
            )

    return run


def _line_up(narrow: str):
    """Ids before each document within its task, whose rows come in curve order; ids as 32-bit integers from here on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = 0
        for b in batches:
            ends = before + b["doc_tokens"].cumsum()
            b["before"] = ends - b["doc_tokens"]
            before = int(ends.iloc[-1]) if len(ends) else before
            b["ids"] = [np.frombuffer(x, narrow).astype("<u4").tobytes() for x in b["ids"]]
            yield b

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, packed into sequences of ``length`` ids.

    One row per piece: doc_id, start (the document's ids before the piece), length, ids (little-endian unsigned
    32-bit), doc_tokens (with the end id), sequence_id (from 0 along the curve), offset (in the sequence),
    curve_key, sequence_length (ids the sequence holds), padding (up to ``length``; none where the sequence's
    length is a power of two).

    A null or empty text is the end id alone. Repeated rows and equal ids are packed once each; ties on the curve go
    by doc_id (null first), then by content. An empty table gives no rows. Other columns are not read. A text of any
    length is cut over as many sequences as it needs.
    """
    spark = docs.sparkSession
    python_ready(spark, TEXT_ROWS)
    narrow = "<u2" if max(end_id + 1, vocabulary_size(path)) <= 1 << 16 else "<u4"
    doc_id = F.col("doc_id").cast("long")
    given = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of().alias("text"))
    coded = keep(given.mapInPandas(_tokenize(path, end_id, narrow), f"{_CODED}, key long"), "pack-ids")
    order = [F.col("key"), F.col("no_id").desc(), F.col("doc_id"), F.xxhash64("ids")]
    sorted_rows = in_order(coded, order, parts_of(spark)).drop("_at")
    line = keep(
        sorted_rows.mapInPandas(_line_up(narrow), f"{_CODED}, key long, _part long, before long"), "pack-line"
    )
    ends = line.groupBy("_part").agg(F.sum("doc_tokens").alias("_n"))
    carry = keep(carried(ends, "_n").select("_part", "_n", "_carry"), "pack-carry")
    # One row per task of the sort, so small whatever the corpus.
    begin = F.col("before") + F.col("_carry")
    placed = line.join(F.broadcast(carry.select("_part", "_carry")), "_part").select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "ids", "doc_tokens", "key", begin.alias("begin"),
        F.explode(F.sequence(F.floor(begin / length), F.floor((begin + F.col("doc_tokens") - 1) / length))).alias("sequence_id"),
    )
    total = F.broadcast(carry.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total")))
    first = F.greatest(F.col("begin"), F.col("sequence_id") * length)
    last = F.least(F.col("begin") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * length)
    size = F.least(F.lit(length), F.col("total") - F.col("sequence_id") * length)
    # A whole power of two has one bit set.
    pieces = placed.withColumn("start", first - F.col("begin")).withColumn("length", last - first)
    return pieces.join(total).select(
        "doc_id", "start", "length",
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
        "doc_tokens", "sequence_id", (first % length).cast("long").alias("offset"), F.col("key").alias("curve_key"),
        size.alias("sequence_length"),
        F.when(F.bit_count(size) == 1, F.lit(0)).otherwise(length - size).cast("long").alias("padding"),
    )
