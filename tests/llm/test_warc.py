"""WARC round trip, its index, and the loser tree."""

import gzip
import hashlib
import random

import pytest

from loadcast.llm import warcindex as W
from loadcast.session import scratch_path


def test_loser_tree_merges():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(k)]
        assert list(W.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_loser_tree_keeps_the_order_of_runs_on_ties():
    runs = [[(1, "a"), (2, "a")], [(1, "b")], [(1, "c"), (2, "c")]]
    assert [x[1] for x in W.LoserTree(runs, lambda x: x[0])] == ["a", "b", "c", "a", "c"]


def brute(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, p in data:
        if i is not None and len(p) >= W.LEAST_REVISIT:
            last[p] = max(i, last.get(p, i))
    out = []
    for i, p in data:
        old = i is not None and p in last and i < last[p]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if old else "response", last[p] if old else None))
    return sorted(out, key=str)


def trip(spark, df):
    folder = scratch_path(spark, "test-warc")
    index = W.merge_index(W.write_archives(df, folder))
    return folder, index, W.read_archives(index)


@pytest.fixture(scope="module")
def odd_pages(spark):
    long = "x" * 3_000_000
    rows = [
        (1, "http://a.org/x", "same" * 400), (2, "http://A.org/x#f", "same" * 400), (3, None, "same" * 400), (4, "http://b.org/", "short"),
        (5, "http://b.org/", "short"), (6, "http://b.org/é\n?q=1", None), (7, "", ""), (None, "http://c.org", "same" * 400),
        (None, None, None), (8, "http://www.a.org/y", long), (9, "no scheme", long), (9, "no scheme", long), (10, "x://h", "é" * 500),
        (11, "x://h", "é" * 500), (12, "x://h", "é" * 499), (13, "x://h", "é" * 499), (14, "http://b.org/", "\r\n\r\n WARC/1.1\r\n"),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, file string, run int")


def test_round_trip(spark, sf_dir, odd_pages):
    for df in (spark.read.parquet(f"{sf_dir}/pages.parquet"), odd_pages):
        rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
        _, _, found = trip(spark, df)
        got = [tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got, key=str) == brute(rows)
        held = {r["page_id"]: bytes(r["payload"]).decode() for r in found.where("record_type = 'response'").collect()}
        assert all(held[i] == (h or "") for i, _, h in rows if i in held and i is not None)


def test_index_is_in_one_order(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(7)
    _, index, _ = trip(spark, pages.union(pages))
    rows = index.orderBy("range", "place").collect()
    keys = [(r["url_key"].encode(), r["time"], r["page_id"]) for r in rows]
    assert keys == sorted(keys) and len(keys) == 2 * pages.count()


def test_archives_are_readable_records(spark, odd_pages):
    folder, index, _ = trip(spark, odd_pages)
    for r in index.collect():
        with open(r["file"], "rb") as f:
            f.seek(r["offset"])
            record = gzip.decompress(f.read(r["size"]))
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode()) and record.endswith(b"\r\n\r\n")


def test_url_keys(spark):
    urls = ["http://WWW.a.org/P?q#f", None, "plain", "https://a.org"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(W.url_key(df["url"])).collect()] == ["org,a,www)/p?q", ")", ")plain", "org,a)"]


def test_no_pages(spark, odd_pages):
    assert trip(spark, odd_pages.limit(0))[2].count() == 0


def test_a_clashing_captured_column(spark, odd_pages):
    """Times and texts that read as one count; any other column of that name is ignored."""
    from pyspark.sql import functions as F

    plain = {(r["page_id"], r["time"]) for r in W.captures(odd_pages.drop("captured")).collect()}
    for value in (F.lit("no time"), F.lit(7), F.array(F.lit(1)), F.lit(None).cast("timestamp")):
        assert {(r["page_id"], r["time"]) for r in W.captures(odd_pages.withColumn("captured", value)).collect()} == plain
    told = W.captures(odd_pages.withColumn("captured", F.lit("2023-05-06 07:08:09"))).collect()
    assert {r["time"] for r in told} == {"20230506070809"}
