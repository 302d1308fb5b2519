"""Mixing sources to target weights by systematic sampling.

Each document of a source is due the same expected number of copies, target over source size. Documents are laid out
by size within their source, the expected copies are summed along that line, one random offset per source is added,
and a document is emitted once for every integer the sum passes on it. Since sizes rise along the line, what is
emitted differs from the target by about one largest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, keep, numbered, same, text_of, whole_row

WEIGHTS = (1, 2, 3)
MOST = 3  # copies: a target stops at this many times its source's size
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Targets of ``sizes`` (source, source_size): shares of the total by weight, none above ``most`` times its size.

    Sources by code point, null last, weigh ``weights`` in turn. What a capped source leaves over is reshared by
    weight until none is above its cap: each round is one aggregate over the sources, and the share per weight only
    grows, so it ends after at most as many rounds as there are sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    named = numbered(sizes, order, "mix-sources")
    given = F.array(*[F.lit(float(w)) for w in weights])
    weighed = keep(
        named.select(
            "source", "source_size", F.get(given, F.pmod("_before", F.lit(len(weights))).cast("int")).alias("weight"),
            (F.col("source_size") * float(most)).alias("cap"),
        ),
        "mix-weights",
    )
    share, capped_before = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(share) > F.col("cap")
        got = weighed.agg(
            F.sum(F.col("source_size").cast("double")).alias("total"), F.sum(F.when(above, F.col("cap"))).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"), F.count_if(above).alias("n_capped"),
        ).first()
        if got["n_capped"] == capped_before or not got["total"] or not got["free"]:
            break
        capped_before = got["n_capped"]
        share = (got["total"] - (got["capped"] or 0.0)) / got["free"]
    return weighed.select("source", "source_size", F.least(F.col("weight") * F.lit(share), F.col("cap")).alias("target"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = SEED, carry_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken; with ``carry_rows`` also ``row``.

    Null text counts no words. A source without words has target 0 and takes nothing. Null is a source of its own,
    last in order. Ties of size go by doc_id, then by content; repeated rows each count. An empty table gives no rows.
    Reruns agree: the offset is a hash of ``seed`` and the source.
    """
    extra = [whole_row(docs)] if carry_rows else []
    text = text_of()
    sized = docs.select(
        F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("content"), *extra,
    )
    if not carry_rows:
        sized = keep(sized, "mix-sizes")
    order = [F.col("source"), F.col("size"), F.col("doc_id"), F.col("content")]
    ranked = numbered(sized, order, "mix-line", ["source"])
    shares = keep(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    joined = ranked.join(shares, same(ranked, shares, ["source"]), "left").drop(shares["source"])
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = (F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("source"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))).cast("decimal(19,18)")
    # Exact decimals: the part of a copy can pass at most one integer on a document.
    part = (F.col("due") - F.floor("due")).cast("decimal(19,18)")
    passed = lambda rank: F.floor(F.col("offset") + rank.cast("decimal(15,0)") * F.col("part"))
    copies = F.floor("due") + passed(F.col("_before") + 1) - passed(F.col("_before"))
    return (
        joined.withColumn("due", due).withColumn("offset", offset).withColumn("part", part)
        .withColumn("copies", copies.cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
            *(["row"] if carry_rows else []),
        )
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the plan says; columns unchanged. Cases as in :func:`plan`."""
    planned = plan(docs, weights, most, seed, carry_rows=True).where(F.col("copies") > 0)
    # A document has ``most`` copies at the most.
    repeated = planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")
