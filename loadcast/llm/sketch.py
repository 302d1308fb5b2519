"""Threshold-scaled document fingerprints.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its size follows the document's.
The fraction is the same for all documents, so fingerprints merge by union, and the shared part of two fingerprints
estimates containment also where one document is far longer than the other. The smallest hash is always kept, so that
a text too short to have a hash below the threshold still has a fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, parts_of, python_ready, text_of

FRACTION = 8  # one hash in so many is kept
SHINGLE = 8  # code points
# Characters hashed at once; a longer text goes in overlapping stretches.
STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _window_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each window of SHINGLE code points, by doubling the window's width."""
    h, width, power = mixed(codes + np.uint64(1)), 1, _BASE
    while width < SHINGLE:
        h = h[: len(h) - width] * power + h[width:]
        power, width = np.uint64(int(power) ** 2 % (1 << 64)), width * 2
    return mixed(h) >> np.uint64(32)


def fingerprint(text: str | None, fraction: int = FRACTION) -> np.ndarray:
    """Sorted 32-bit hashes below 2**32 / fraction, with the smallest hash in any case; none for an empty text."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(codes):
        return np.zeros(0, np.uint32)
    if len(codes) < SHINGLE:
        codes = np.concatenate([codes, np.full(SHINGLE - len(codes), 1 << 21, np.uint64)])
    kept, least = [], None
    for k in range(0, len(codes) - SHINGLE + 1, STRETCH):
        h = _window_hashes(codes[k : k + STRETCH + SHINGLE - 1])
        least = h.min() if least is None else min(least, h.min())
        kept.append(h[h < (1 << 32) // fraction])
    found = np.unique(np.concatenate(kept)).astype(np.uint32)
    return found if len(found) else np.array([least], np.uint32)


def merge(a: np.ndarray, b: np.ndarray, fraction: int = FRACTION) -> np.ndarray:
    """The fingerprint of both texts' shingles together."""
    both = np.union1d(a, b)
    below = both[both < (1 << 32) // fraction]
    return below if len(below) else both[:1]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return shared(a, b) / len(a) if len(a) else 1.0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness; two empty fingerprints are alike."""
    n = shared(a, b)
    all_of = len(a) + len(b) - n
    return n / all_of if all_of else 1.0


def text_form(f: np.ndarray) -> str:
    """Base64 of the sorted hashes as little-endian unsigned 32-bit integers."""
    return base64.b64encode(f.astype("<u4").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u4")


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next document's first."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_COLUMNS = (
    "doc_id long, no_id boolean, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, kept_of_edited double"
)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a bucket come in descending id, then the row that follows the bucket's last, marked ``ahead``."""
    held, bucket = None, None

    def row(one, nxt):
        doc_id, no_id, text, f = one
        after, nf = nxt
        changed = edited(text, after)
        ef = fingerprint(changed)
        return (
            doc_id, no_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), text_form(f), text_form(ef),
            likeness(f, ef), likeness(f, nf), containment(ef, f),
        )

    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    empty = ("", np.zeros(0, np.uint32))
    done_ahead = False
    for b in batches:
        out = []
        for doc_id, no_id, text, at, ahead in zip(b["doc_id"], b["no_id"], b["text"], b["bucket"], b["ahead"]):
            if no_id:  # stands alone: nothing follows it
                out.append(row((doc_id, True, text, fingerprint(text)), empty))
                continue
            if at != bucket:
                if held is not None:
                    out.append(row(held, empty))
                held, bucket, done_ahead = None, at, False
            if ahead and done_ahead:
                continue
            f = fingerprint(text)
            if held is not None:
                out.append(row(held, (text, f)))
            held = None if ahead else (doc_id, False, text, f)
            done_ahead = bool(ahead)
        if out:
            yield pd.DataFrame(out, columns=names)
    if held is not None:
        yield pd.DataFrame([row(held, empty)], columns=names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness and that to the next document.

    The next document is the one of the next smaller doc_id; after the smallest comes the largest. Rows of equal
    doc_id follow each other by text. A row without doc_id is followed by nothing: its last third just goes. Null text
    is empty. An empty fingerprint is alike to an empty one only. A single document follows itself. Other columns
    are not read.

    The ids are cut into ranges at quantiles; a range gets, besides its rows, those of the next range's first id, so
    each document meets its follower in one shuffle of the texts, streamed in id order.
    """
    spark = docs.sparkSession
    python_ready(spark)
    n = 4 * parts_of(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # As many numbers as ranges: the first id of each, descending.
    at = [k / n for k in range(n, 0, -1)]
    found = given.agg(F.percentile_approx("doc_id", at, 100 * n).alias("cuts"), F.max("doc_id").alias("most")).first()
    firsts = sorted({*(found["cuts"] or []), *([found["most"]] if found["most"] is not None else [])}, reverse=True)
    rising = np.array(firsts[::-1], np.int64)

    @F.pandas_udf("struct<spot: int, first: boolean>")
    def place(ids: pd.Series) -> pd.DataFrame:
        known = ids.to_numpy()
        at = np.minimum(np.searchsorted(rising, known, "left"), len(rising) - 1) if len(rising) else np.zeros(len(ids), np.int64)
        first = rising[at] == known if len(rising) else np.zeros(len(ids), bool)
        return pd.DataFrame({"spot": (len(rising) - 1 - at).astype(np.int32), "first": first})

    # The first id of a range also goes to the range before it, that of the first range to the last.
    spot = F.when(F.col("no_id"), F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).otherwise(F.col("at.spot"))
    own = F.struct(spot.alias("bucket"), F.lit(False).alias("ahead"))
    before = F.struct(F.pmod(spot - 1, F.lit(max(1, len(firsts)))).alias("bucket"), F.lit(True).alias("ahead"))
    named = given.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    dealt = named.withColumn("at", place("doc_id")).withColumn(
        "to", F.explode(F.when(~F.col("no_id") & F.col("at.first"), F.array(own, before)).otherwise(F.array(own)))
    )
    rows = dealt.select("doc_id", "no_id", "text", "to.bucket", "to.ahead")
    order = [F.col("bucket"), F.col("ahead"), F.col("doc_id").desc(), F.col("text")]
    made = rows.repartition(parts_of(spark), "bucket").sortWithinPartitions(*order).mapInPandas(_compare, _COLUMNS)
    return made.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
