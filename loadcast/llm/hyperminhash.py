"""MinHash near-dedup with HyperMinHash registers.

A document's shingle hashes fall into 512 buckets by their first bits; of each bucket's smallest hash, a register keeps
the count of leading zeros and the next ten bits. Empty buckets borrow from a filled one, tried in an order fixed per
bucket. Bands of eight registers are the keys by which documents meet: steep enough that documents which only share a
passage rarely do. Likeness is estimated from equal registers, corrected for those that are equal by chance, and
what can be a link is verified on the full shingle sets.

Documents with equal sets are one node throughout, and buckets of the same nodes are one bucket. A bucket is never
expanded into rows of pairs. Buckets are split by classes of set sizes that a link allows. First, every node is compared to one center of each of its buckets, which connects most of
what belongs together. Then, in the buckets whose nodes still lie in different components, tasks compare the nodes in
memory: by estimate all of them, by full sets those that have a possible partner. Large buckets are cut into blocks, so
a task holds two blocks at a time. No link that a shared band could show is lost, and a task returns links enough to
connect what it found.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, mixed, parts_of, python_ready, text_of
from .components import components, stars
from .shingles import WORDS, shingle_set

REGISTERS = 512
BAND = 8
BANDS = REGISTERS // BAND
MANTISSA = 10
PERCENT = 80
# Standard errors of the estimate below the bound at which a pair is given up; registers it is made from.
SURE = 6
COMPARED = 256
# Nodes, and shingles, of a block of a bucket.
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000
_COLUMNS = 4096
# Ids that are sent to every task to pick texts by, 8 bytes each; beyond, the texts are shuffled.
MOST_SENT = 2_000_000

_BUCKET_BITS = REGISTERS.bit_length() - 1
_LOW_BITS = 53  # of the 64 - _BUCKET_BITS left, so that a double holds them exactly
_DROPPED = 64 - _BUCKET_BITS - _LOW_BITS
# For each bucket, the order in which it tries others to borrow from.
_TRIES = np.array([np.random.default_rng(j).permutation(REGISTERS) for j in range(REGISTERS)])


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers of sorted distinct hashes (at least one), as unsigned 16-bit integers."""
    bucket = (hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    value = (hashes[first] >> np.uint64(_DROPPED)) & np.uint64((1 << _LOW_BITS) - 1)
    size = np.frexp(value.astype(np.float64))[1]  # bits of the value
    zeros = (_LOW_BITS - size).astype(np.uint64)
    rest = (value << (zeros + np.uint64(1))) & np.uint64((1 << _LOW_BITS) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    full = np.zeros(REGISTERS, bool)
    full[bucket[first]] = True
    out[bucket[first]] = ((zeros << np.uint64(MANTISSA)) | (rest >> np.uint64(_LOW_BITS - MANTISSA))).astype(np.uint16)
    if len(first) < REGISTERS:
        empty = np.flatnonzero(~full)
        tries = _TRIES[empty]
        out[empty] = out[tries[np.arange(len(empty)), full[tries].argmax(axis=1)]]
    return out


def _chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of registers of sets of n and m hashes without a common one that are equal all the same.

    A bucket's smallest of x uniform hashes has at least k leading zeros with probability 1 - (1 - 2**-k)**x; within a
    count of zeros, the mantissa's values are taken as alike.
    """
    k = np.arange(_LOW_BITS + 1)

    def zeros(x):
        x = np.maximum(x[:, None] / REGISTERS, 1.0)
        tail = -np.expm1(x * np.log1p(-np.minimum(0.5 ** k, 1 - 1e-12))[None, :])
        tail[:, 0] = 1.0
        return tail - np.concatenate([tail[:, 1:], np.zeros((len(x), 1))], axis=1)

    return (zeros(n) * zeros(m)).sum(axis=1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected likeness of rows of registers, of sets of n and m hashes."""
    return _corrected((a == b).mean(axis=1), n, m)


def _corrected(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    by_chance = _chance(np.asarray(n, float), np.asarray(m, float))
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def _least(percent: int, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimate below which a pair cannot be a link, but for a chance in a thousand million.

    Registers of a small set repeat its few hashes, which doubles the variance of as many draws at most.
    """
    p = percent / 100
    return p - SURE * np.sqrt(2 * p * (1 - p) / np.minimum(COMPARED, np.minimum(n, m)))


def _band_keys(r: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of eight 16-bit registers."""
    two = np.ascontiguousarray(r, "<u2").view("<u8").reshape(BANDS, 2)
    return mixed(mixed(two[:, 0]) + two[:, 1]).view("<i8")


def _sketch(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, codes, bands = [], [], []
            for text in b["text"]:
                s = shingle_set(text, words)
                n.append(len(s))
                codes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(_band_keys(registers(s)) if len(s) else None)
            yield pd.DataFrame(
                {"doc_id": b["doc_id"], "no_id": b["no_id"], "content": b["content"], "n_shingles": n, "code": codes, "bands": bands}
            )

    return run


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, no_id, content (a hash of the text), n_shingles, code (of the set), bands (keys)."""
    doc_id = F.col("doc_id").cast("long")
    given = docs.select(
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of().alias("text"),
        F.xxhash64(text_of()).alias("content"),
    )
    return given.mapInPandas(
        _sketch(words), "doc_id long, no_id boolean, content long, n_shingles long, code binary, bands array<long>"
    )


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [shingle_set(t, words) for t in b["text"]]
            some = [registers(x)[:COMPARED].astype("<u2").tobytes() for x in found]
            yield pd.DataFrame({"node": b["node"], "shingles": [x.tobytes() for x in found], "some": some})

    return run


def _full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles, some registers) of each of ``nodes`` (node, least, content), from the text of its first document."""
    wanted = keep(nodes.select("node", F.col("least").alias("of"), F.col("content").alias("as")), "mh-wanted")
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    met = given.join(wanted, (F.col("doc_id") == F.col("of")) & (F.xxhash64("text") == F.col("as")))
    found = met.select("node", "text").mapInPandas(_sets(words), "node long, shingles binary, some binary")
    # Repeated rows give a node's set more than once.
    return keep(found.groupBy("node").agg(F.any_value("shingles").alias("shingles"), F.any_value("some").alias("some")), "mh-sets")


def _fit(n: Column, m: Column, percent: int) -> Column:
    """Sizes that a link allows."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _possible(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x, y = (np.stack([np.frombuffer(r, "<u2") for r in b[c]]) for c in ("a_some", "b_some"))
                n, m = b["a_n"].to_numpy(), b["b_n"].to_numpy()
                yield b.loc[estimate(x, y, n, m) >= _least(percent, n, m), ["a", "b"]]

    return run


def _linked(shared: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (n + m - shared)


def _verified(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = []
            for x, y in zip(b["a_set"], b["b_set"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
            yield b.loc[np.array(ok, bool), ["a", "b"]]

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, a_n, b_n) that are links: by estimate, then by full sets."""
    for side in ("a", "b"):
        one = sets.select(F.col("node").alias(f"{side}_node"), F.col("some").alias(f"{side}_some"))
        pairs = pairs.join(one, F.col(side) == F.col(f"{side}_node"))
    pairs = pairs.select("a", "b", "a_n", "b_n", "a_some", "b_some").mapInPandas(_possible(percent), "a long, b long")
    for side in ("a", "b"):
        one = sets.select(F.col("node").alias(f"{side}_node"), F.col("shingles").alias(f"{side}_set"))
        pairs = pairs.join(one, F.col(side) == F.col(f"{side}_node"))
    return keep(pairs.select("a", "b", "a_set", "b_set").mapInPandas(_verified(percent), "a long, b long"), "mh-links")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that come sorted by ``keys``; what is held is one group."""
    held: list[pd.DataFrame] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(b)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            now = tuple(k[i])
            if held and now != last:
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(b.iloc[i:j])
            last = now
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held)


def _open(g: pd.DataFrame, percent: int) -> np.ndarray:
    """Pairs of a group of blocks that are still to compare: of different components, fit in size, and of both blocks."""
    label, n, block = g["label"].to_numpy(), g["n"].to_numpy(), g["block"].to_numpy()
    low, high = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    out = (label[:, None] != label[None, :]) & (100 * low >= percent * high)
    if g["block_a"].iloc[0] != g["block_b"].iloc[0]:
        out &= block[:, None] != block[None, :]
    return out


_GROUP = ["bucket", "block_a", "block_b"]


def _with_partner(percent: int):
    """Nodes of a group that some other node may link with, by estimate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, _GROUP):
            x = np.stack([np.frombuffer(r, "<u2") for r in g["some"]])
            n = g["n"].to_numpy()
            todo = _open(g, percent)
            some = np.zeros(len(g), bool)
            for i in np.flatnonzero(todo.any(axis=1)):
                j = np.flatnonzero(todo[i, i + 1 :]) + i + 1
                if len(j):
                    m = np.full(len(j), n[i])
                    ok = _corrected((x[i] == x[j]).mean(axis=1), m, n[j]) >= _least(percent, m, n[j])
                    some[i] |= ok.any()
                    some[j[ok]] = True
            if some.any():
                yield g.loc[some, [*_GROUP, "block", "node", "n", "label"]]

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: products of the incidence matrix, without hashes that only one set has."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], column[common]
    out = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers, exact up to 2**24 a product
    total = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    used, column = np.unique(column, return_inverse=True)
    edges = np.searchsorted(column, np.arange(0, len(used) + _COLUMNS, _COLUMNS))
    for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
        m = np.zeros((len(sets), _COLUMNS), np.float32)
        m[owner[i:j], column[i:j] - k * _COLUMNS] = 1
        np.matmul(m, m.T, out=out)
        total += out.astype(np.int64)
    return total


def _block_links(percent: int):
    """Links enough to connect what full sets connect within a group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, _GROUP):
            sets, n = [np.frombuffer(s, np.uint64) for s in g["shingles"]], g["n"].to_numpy()
            if len(g) == 2:
                shared = np.full((2, 2), len(np.intersect1d(*sets, assume_unique=True)))
            else:
                shared = shared_counts(sets)
            links = _open(g, percent) & _linked(shared, n[:, None], n[None, :], percent)
            if links.any():
                node = g["node"].to_numpy()
                a, b = stars(node, node, links)
                yield pd.DataFrame({"a": a[a != b], "b": b[a != b]}).drop_duplicates()

    return run


def _in_blocks(members: DataFrame) -> DataFrame:
    """``members`` dealt to pairs of blocks of their bucket: one pair for a small one."""
    sizes = members.groupBy(F.col("bucket").alias("at")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    cuts = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(sizes.select("at", cuts.alias("cuts")), F.col("bucket") == F.col("at")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    )
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        "bucket", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", "node", "n", "label"
    )


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components within buckets of ``members`` (bucket, node, n, label)."""
    spark = members.sparkSession
    parts = parts_of(spark)

    def gathered(rows: DataFrame, column: str) -> DataFrame:
        one = sets.select(F.col("node").alias("of"), column)
        whole = rows.join(one, F.col("node") == F.col("of")).drop("of")
        return whole.repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP)

    kinds = "bucket long, block_a int, block_b int, block int, node long, n long, label long"
    partnered = keep(gathered(_in_blocks(members), "some").mapInPandas(_with_partner(percent), kinds), "mh-partnered")
    return keep(gathered(partnered, "shingles").mapInPandas(_block_links(percent), "a long, b long"), "mh-rest")


def near_documents(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, content, n_shingles, component_id, kept.

    Links documents whose sets of word shingles have 100 * shared >= percent * together. The component is the smallest
    doc_id reachable, kept means that it is the document's own. Null, empty and blank texts have an empty set and link
    with nothing. Rows of one doc_id but different texts are linked each by its own text; repeated rows give repeated
    results. A row without doc_id links with nothing: component null, kept. An empty table gives no rows. Other columns
    are not read; texts of any length are taken whole.
    """
    python_ready(docs.sparkSession)
    rows = keep(sketches(docs, words), "mh-sketches")
    sets_of = rows.where(F.col("code").isNotNull() & ~F.col("no_id"))
    first = F.min_by(F.struct("content", "n_shingles", "bands"), F.struct("doc_id", "content"))
    grouped = sets_of.groupBy("code").agg(F.min("doc_id").alias("least"), first.alias("first"))
    nodes = keep(
        grouped.select("code", "least", "first.content", F.col("first.n_shingles").alias("n"), "first.bands", F.monotonically_increasing_id().alias("node")),
        "mh-nodes",
    )
    spread = nodes.select("node", "n", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "node", F.col("n").cast("int").alias("n")
    )
    shared = spread.groupBy(F.col("bucket").alias("at")).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    met = spread.join(keep(shared.select("at"), "mh-shared"), F.col("bucket") == F.col("at"), "left_semi")
    # Two sizes that a link allows fall into the same class of sizes or the next: each node goes to its own and the next.
    width = math.log(100 / min(percent, 99)) * (1 + 1e-9)
    size = F.floor(F.log("n") / F.lit(width)).cast("int")
    classed = keep(
        met.select("node", "n", F.explode(F.array(F.xxhash64("bucket", size), F.xxhash64("bucket", size + 1))).alias("bucket")), "mh-classed"
    )
    # Buckets of two nodes and more, those of the same nodes once, each with a center; one order for all, so few nodes are centers.
    buckets = classed.groupBy(F.col("bucket").alias("at")).agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.min("node").alias("lo"), F.max("node").alias("hi"),
        F.min_by(F.struct("node", "n"), F.xxhash64("node")).alias("center"),
    ).where(F.col("members") > 1)
    buckets = keep(buckets.dropDuplicates(["members", "mark", "lo", "hi"]).select("at", "center"), "mh-buckets")
    members = keep(
        classed.join(buckets, F.col("bucket") == F.col("at")).select(
            "bucket", "node", F.col("n").cast("long").alias("n"), F.col("center.node").alias("c"), F.col("center.n").cast("long").alias("c_n")
        ),
        "mh-members",
    )
    met = members.select(F.col("node").alias("of")).distinct()
    sets = _full_sets(docs, nodes.join(met, F.col("node") == F.col("of"), "left_semi"), words)
    ahead = F.col("node") < F.col("c")
    pairs = members.where((F.col("node") != F.col("c")) & _fit(F.col("n"), F.col("c_n"), percent)).select(
        F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"),
        F.when(ahead, F.col("n")).otherwise(F.col("c_n")).alias("a_n"), F.when(ahead, F.col("c_n")).otherwise(F.col("n")).alias("b_n"),
    ).distinct()
    found = _links(pairs, sets, percent)
    names = components(found).select(F.col("node").alias("of"), "component")
    named = members.join(names, F.col("node") == F.col("of"), "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("label")
    )
    left = named.groupBy(F.col("bucket").alias("at")).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    left = left.where(F.col("lo") != F.col("hi")).select("at")
    found = found.union(_rest(keep(named.join(left, F.col("bucket") == F.col("at"), "left_semi"), "mh-left"), sets, percent))
    ids = nodes.select("code", "least", "node")
    named = ids.join(components(found).withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    named = keep(named.select("code", "least", F.coalesce("component", "node").alias("component")), "mh-named")
    lowest = named.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    classes = named.join(lowest, F.col("component") == F.col("of")).select(F.col("code").alias("set_code"), "component_id")
    out = rows.select("doc_id", "no_id", "content", "n_shingles", "code").join(classes, F.col("code") == F.col("set_code"), "left")
    component = F.when(~F.col("no_id"), F.coalesce("component_id", "doc_id"))
    return out.select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "content", "n_shingles", component.alias("component_id"),
        (F.col("no_id") | (F.col("doc_id") == component)).alias("kept"),
    )


def drop_near_documents(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component; columns unchanged.

    Cases as in :func:`near_documents`; of repeated rows, equal in doc_id and text, one stays.
    """
    judged = keep(near_documents(docs, percent, words).select("doc_id", "content", "kept"), "mh-judged")
    content = F.xxhash64(text_of())
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_as")).distinct()
    left = docs.join(gone, (F.col("doc_id") == F.col("gone_id")) & (content == F.col("gone_as")), "left_anti")
    again = judged.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id", "content").count().where("count > 1")
    again = keep(again.select(F.col("doc_id").alias("again_id"), F.col("content").alias("again_as")), "mh-again")
    if again.isEmpty():
        return left
    twice = (F.col("doc_id") == F.col("again_id")) & (content == F.col("again_as"))
    return left.join(again, twice, "left_anti").unionByName(left.join(again, twice, "left_semi").dropDuplicates(["doc_id", "text"]))
