"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on the document ids.

Files hold the documents in ascending id order, one file per range, each with its place in that order. Readers split
files by stripe; row-index ranges and Bloom filters on ``doc_id`` skip stripes and row groups that cannot hold an id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, in_order, keep, parts_of, python_ready, text_of
from .tokens import END_ID, TEXT_ROWS, encode_all

SCHEMA = "doc_id long, ids array<int>, n_tokens long, before long, part long"
# Bytes of a stripe, rows of a row group, share of false hits of a Bloom filter.
STRIPE_BYTES = 16 << 20
GROUP_ROWS = 1000
FALSE_HITS = 0.01


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for b in batches:
            got = encode_all(path, b.column("text").to_pylist(), end_id)
            sizes = np.array([len(x) // 4 for x in got], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.frombuffer(b"".join(got), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), ids, pa.array(sizes), pa.array(before + starts[:-1]), b.column("_part")],
                ["doc_id", "ids", "n_tokens", "before", "part"],
            )
            before += int(starts[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write them to ``path`` in ascending doc_id order.

    A null or empty text is the end id alone; a null doc_id sorts first; rows of equal doc_id follow each other by
    text. An empty table writes no rows. Other columns are not read. Ids must fit 31 bits.
    """
    python_ready(docs.sparkSession, TEXT_ROWS)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ranges = [F.col("doc_id"), F.substring("text", 1, 40)]
    rows = in_order(given, [F.col("doc_id"), F.col("text")], parts_of(docs.sparkSession), ranges).drop("_at")
    writer = rows.mapInArrow(_encode(tokenizer, end_id), SCHEMA).write
    options = {
        "compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.create.index": "true", "orc.row.index.stride": GROUP_ROWS,
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_HITS,
    }
    writer.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """Documents of written files: doc_id, ids, n_tokens, before (ids before it in its file), part (the file's place).

    ``doc_ids`` reads a request's documents only; the filter reaches the files, which skip stripes without them.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(d) for d in doc_ids]))


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before it, over all files. Reads two integer columns for it."""
    sums = tokens.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    carry = keep(carried(sums, "_n").select(F.col("_part").alias("part"), "_carry"), "token-carry")
    # One row per file.
    return tokens.join(F.broadcast(carry), "part").withColumn("start", F.col("before") + F.col("_carry"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for b in batches:
        ids = b.column("ids")
        flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        sums = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    python_ready(tokens.sparkSession)
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def summary_of(path: str) -> pd.DataFrame:
    """Stripes and rows per local ORC file, from the metadata alone; for looking at what was written."""
    import glob

    from pyarrow import orc

    found = [(f, orc.ORCFile(f)) for f in sorted(glob.glob(f"{path}/*.orc"))]
    return pd.DataFrame([{"file": f, "stripes": x.nstripes, "rows": x.nrows} for f, x in found])
